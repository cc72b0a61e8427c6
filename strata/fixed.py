"""Names and formats that must equal the source pipeline's.

They decide where data lives and what it is called. Changing one breaks
compatibility with lakes and tables the source pipeline wrote.
"""

# Fixed values -----------------------------------------------------------
DOMAIN_DIR_PREFIX = "LOCAL_"          # per-domain folder: LOCAL_<DOMAIN upper case>
PUBLISHED_TABLE_SUFFIX = "_diamond"   # published table: <domain>_diamond
RUN_STAMP_FORMAT = "%Y%m%d%H%M"       # run key: minute stamp, 12 digits
DAY_STAMP_FORMAT = "%Y%m%d"           # day of a run key: its first 8 digits
DOMAIN_NAME_SEPARATOR = "_"           # domain = file name stem up to the first "_", lower case
APPOINTMENT_COLUMNS = ("nombre", "edad", "obra_social", "fecha_turno")
APPOINTMENT_NOT_BLANK = ("nombre", "obra_social")
APPOINTMENT_AGE = ("edad", 0, 120)    # kept when 0 < edad < 120 (both bounds exclusive)
APPOINTMENT_DATE = "fecha_turno"      # text before the first " ", parsed as yyyy-MM-dd
DATE_SEPARATOR = " "
DATE_FORMAT = "yyyy-MM-dd"
LEGACY_RUN_NAME = r"^(?P<stem>.+)_(?P<run>[0-9]{12})(?:[0-9]{5})?(?P<ext>\.[A-Za-z0-9]+)?$"  # <stem>_<run key>[part number][.ext]
LEGACY_BACKUP_DIR = "diamond"         # folder of the older CSV backups, <table>_<run key>.csv
