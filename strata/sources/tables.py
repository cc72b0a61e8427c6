"""Publishing a frame as a table: catalog table or JDBC table, create-if-absent.

Publishing is "create and load when the table is absent, otherwise do
nothing" (no append, no refresh). Data goes straight from the executors to
the target (no CSV hop, no collection to the driver), and a failed publish
leaves no half-loaded table behind, so it can simply be retried.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import jvm_context


def publishable_column(c: Column, data_type: T.DataType) -> Column:
    """``c`` (of ``data_type``) cast to a type every SQL table can hold (see ``to_publishable``)."""
    if isinstance(data_type, T.TimestampType):
        return c.cast(T.TimestampNTZType())
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    if isinstance(data_type, (T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType)):
        return c.cast(T.StringType())
    return c


def to_publishable(df: DataFrame) -> DataFrame:
    """Cast columns to types every SQL table can hold, keeping names and order.

    * timestamp (session zone) -> timestamp without zone (wall-clock time in
      the session zone), so it lands as ``TIMESTAMP``;
    * arrays, structs and maps -> JSON text;
    * intervals -> text.
    All other types pass unchanged and map through the JDBC dialect (or the
    catalog) as they are.
    """
    return df.select(*[publishable_column(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
                       for f in df.schema.fields])


def publish_table(
    df: DataFrame,
    name: str,
    path: str,
    fmt: str = "parquet",
    mode: str = "ignore",
) -> bool:
    """Save ``df`` as catalog table ``name`` unless it exists. Returns True if written now.

    The table is external at ``path`` (use shared storage). Spark writes the
    files first and registers the table only after the write committed, so a
    failed publish leaves no table, and the next attempt replaces whatever
    files it left. (A managed table could not be retried: files left in its
    location by a driver that died would refuse every later attempt.)
    """
    spark = df.sparkSession
    existed = spark.catalog.tableExists(name)
    df.write.mode(mode).format(fmt).option("path", path).saveAsTable(name)
    return mode != "ignore" or not existed


def publish_table_at(df: DataFrame, name: str, path: str) -> bool:
    """``publish_table`` where others may create the table at the same time. ``path`` is this call's own; returns
    True if the table lies there, so of several callers exactly one gets True: the catalog takes a name once."""
    spark = df.sparkSession
    try:
        publish_table(df, name, path)
    except AnalysisException:
        if not spark.catalog.tableExists(name):
            raise
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    return place is not None and place.data_type.rstrip("/").endswith("/" + path.rstrip("/").rpartition("/")[2])


@dataclass(frozen=True)
class JdbcTarget:
    """Where a JDBC publish goes. ``properties`` holds user, password, driver, ...

    ``num_partitions`` bounds the concurrent connections (Spark coalesces the
    frame to it before loading); keep it at what the database can take.
    """

    url: str
    properties: dict = field(default_factory=dict)
    num_partitions: int | None = 32
    batchsize: int | None = None


def _jdbc_connection(spark: SparkSession, target: JdbcTarget):
    jvm = jvm_context(spark)._jvm
    props = jvm.java.util.Properties()
    for k, v in target.properties.items():
        props.setProperty(k, str(v))
    driver = target.properties.get("driver")
    if driver:
        # Load the driver the way Spark's own JDBC source does, so drivers
        # shipped with --jars / spark.jars are found from the driver too; the
        # plain class lookup is the fallback should that helper ever move.
        try:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
        except Exception:
            jvm.java.lang.Class.forName(driver)
    return jvm.java.sql.DriverManager.getConnection(target.url, props)


def _jdbc_execute(spark: SparkSession, target: JdbcTarget, sql: str) -> None:
    conn = _jdbc_connection(spark, target)
    try:
        st = conn.createStatement()
        try:
            st.execute(sql)
        finally:
            st.close()
        if not conn.getAutoCommit():
            conn.commit()
    finally:
        conn.close()


def _jdbc_count(spark: SparkSession, target: JdbcTarget, table: str) -> int:
    conn = _jdbc_connection(spark, target)
    try:
        st = conn.createStatement()
        try:
            rs = st.executeQuery(f"SELECT COUNT(*) FROM {table}")
            rs.next()
            return rs.getLong(1)
        finally:
            st.close()
    finally:
        conn.close()


def jdbc_table_exists(spark: SparkSession, target: JdbcTarget, table: str) -> bool:
    """True when ``table`` exists at the target.

    Looked up in the database catalog by exact name (case-insensitive), in
    the schema the name gives or else the connection's current schema.
    """
    conn = _jdbc_connection(spark, target)
    try:
        schema, _, bare = table.rpartition(".")
        schema = schema or conn.getSchema()
        meta = conn.getMetaData()
        esc = meta.getSearchStringEscape() or ""

        def literal(x: str) -> str:  # a name as a LIKE pattern that matches only itself
            if not esc:
                return x
            return x.replace(esc, esc + esc).replace("_", esc + "_").replace("%", esc + "%")

        for candidate in {bare, bare.upper(), bare.lower()}:
            rs = meta.getTables(None, None, literal(candidate), None)
            try:
                while rs.next():
                    name, owner = rs.getString("TABLE_NAME"), rs.getString("TABLE_SCHEM")
                    if name.lower() == bare.lower() and \
                            (schema is None or (owner or "").lower() == schema.lower()):
                        return True
            finally:
                rs.close()
        return False
    finally:
        conn.close()


def _rename_sql(url: str, old: str, new: str) -> str:
    bare = new.rpartition(".")[2]  # the new name is never schema-qualified
    if url.startswith("jdbc:derby:"):
        return f"RENAME TABLE {old} TO {bare}"
    return f"ALTER TABLE {old} RENAME TO {bare}"


def publish_jdbc(df: DataFrame, target: JdbcTarget, table: str) -> bool:
    """Create-if-absent publish into a JDBC table. Returns True if written now.

    The rows are loaded by the executors, partition by partition, into a
    staging table of this attempt (``<table>__staging_<suffix>``); only after
    the load succeeded and the staging table has exactly as many rows as
    ``df`` (counted by Spark, no columns read) is it renamed to ``table``. (A committed task that is run
    again, after a lost executor, inserts its rows twice: that is found here.)
    A failure at any point leaves ``table`` absent, so a retry loads it
    again -- never an empty, half-filled or doubled table that later runs
    would skip. Column types come from Spark's dialect for the target database.
    """
    spark = df.sparkSession
    if jdbc_table_exists(spark, target, table):
        return False
    staging = f"{table}__staging_{uuid.uuid4().hex[:8]}"
    w = df.write.mode("overwrite").format("jdbc").option("url", target.url).option("dbtable", staging)
    for k, v in target.properties.items():
        w = w.option(k, v)
    if target.num_partitions:
        w = w.option("numPartitions", target.num_partitions)
    if target.batchsize:
        w = w.option("batchsize", target.batchsize)
    try:
        w.save()
        there, sent = _jdbc_count(spark, target, staging), df.count()
        if there != sent:
            raise RuntimeError(f"{staging} has {there} rows, {sent} were sent; {table} is not published")
        _jdbc_execute(spark, target, _rename_sql(target.url, staging, table))
    except Exception:
        raced = jdbc_table_exists(spark, target, table)  # someone else published first
        if jdbc_table_exists(spark, target, staging):
            _jdbc_execute(spark, target, f"DROP TABLE {staging}")
        if raced:
            return False
        raise
    return True
