"""Runs of repeated words against trying every period at every place."""

import random
import re
import zlib

import numpy as np
import pytest

from strata.llm import periodic
from tests.conftest import SF_SMALL
from tests.llm.brute import sha


def runs(words):
    """Every run at least two periods long, from the places where words ``p`` apart are equal."""
    codes = {}
    w = np.array([codes.setdefault(x, len(codes)) for x in words], np.int64)
    n, out = len(w), []
    for p in range(1, n // 2 + 1):
        same = np.concatenate(([False], w[:-p] == w[p:], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < p:
                continue
            part = w[start:end + p]
            if not any(p % q == 0 and (part[:-q] == part[q:]).all() for q in range(1, p)):
                out.append((start, end - start + p, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapse(words, found):
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def changed(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def fibonacci(n):
    a, b = "b", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def test_random_words():
    rnd = random.Random(3)
    for _ in range(2000):
        n = rnd.randrange(45)
        words = [rnd.randrange(rnd.choice([1, 2, 2, 3, 8])) for _ in range(n)]
        if n and rnd.random() < 0.5:
            p = rnd.randrange(1, n + 1)
            words = [words[i % p] for i in range(n)]
        assert periodic.find_runs(np.array(words, np.int64)) == runs(words)


@pytest.mark.parametrize("words", [
    ["x"] * 3000, ["x", "y"] * 1000 + ["x"], fibonacci(1500), list("ab" * 50 + "c") * 12, [str(i) for i in range(500)] * 3,
    [str(i) for i in range(400)], list("aab" * 40 + "aac" * 40 + "aab" * 40), [], ["x"], ["x", "x"],
], ids=range(10))
def test_hard_words(words):
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    assert periodic.find_runs(np.array([codes[w] for w in words], np.int64)) == runs(words)


def test_suffix_and_lcp_arrays():
    rnd = random.Random(4)
    for _ in range(300):
        s = [rnd.randrange(3) for _ in range(rnd.randrange(1, 60))]
        order, levels = periodic.suffix_array(np.array(s))
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        assert levels[-1][order].tolist() == list(range(len(s)))
        common = [0]
        for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
            k = 0
            while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            common.append(k)
        assert periodic.lcp_array(order, levels).tolist() == common


def test_documents_of_a_slice_do_not_touch(monkeypatch):
    """Equal documents one after another are no run; slices of any size give the same."""
    text = b"one two three four one two three four one two three four one two"
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(periodic, "SLICE_BYTES", size)
        parts = periodic._slices([text, text, None, b"", b" \t\n", text + b" end", b"a b c d e f g"])
        found = [x for part in parts for x in periodic._of_slice(part, 12)]
        assert [r for r, _ in found] == [[(0, 14, 4)], [(0, 14, 4)], [], [], [], [(0, 14, 4)], []]
        assert [t for _, t in found] == ["one two three four"] * 2 + [""] * 3 + ["one two three four end", "a b c d e f g"]


def test_query_matches_every_period_tried(result, spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    found = result("op11_periodic_runs")
    assert len(found.rows) == len(texts)
    n_periodic = 0
    for r in found.rows:
        words = changed(r.doc_id, split(texts[r.doc_id]))
        kept = [x for x in runs(words) if x[1] >= 12]
        best = min(kept, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if kept else None
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in kept)
        assert tuple(r) == (r.doc_id, len(kept), *best, milli, sha(lines), sha(collapse(words, kept)))
        n_periodic += bool(kept)
    assert n_periodic > 10


def test_operator_on_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.withColumnRenamed("rank", "RUNS").withColumnRenamed("slot", "collapsed")
    found = periodic.periodic_runs(clash)
    assert [c for c in found.columns if c.lower() in ("runs", "collapsed")] == ["runs", "collapsed"]
    rows = found.select("text", "runs", "collapsed").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        words = split(r.text)
        if len(words) > 5000:
            continue
        kept = [x for x in runs(words) if x[1] >= 12]
        assert [tuple(x) for x in r.runs] == kept and r.collapsed == collapse(words, kept)
    assert periodic.periodic_runs(no_docs).count() == 0
    short = spark.createDataFrame([(1, "a a a b b")], "doc_id long, text string")
    assert [tuple(x) for x in periodic.periodic_runs(short, min_length=2).first().runs] == [(0, 3, 1), (3, 2, 1)]
