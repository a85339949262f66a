"""They must equal those of the services and tables served here."""

# Accepted quality flag of a daily level, and the source name stored with it.
GOOD_QUALITY = "Good"
LEVEL_SOURCE = "EA"

# The daily measure of a station: parameter and period in seconds, as text.
DAILY_PARAMETER = "level"
DAILY_PERIOD = "86400"

# Warnings at this severity level or a lower one are polled.
MAX_SEVERITY_LEVEL = 3

# Markers around the station reference inside a reading's @id.
REF_AFTER = "/readings/"
REF_UNTIL = "/"
REF_BEFORE = "-level-"

# Items of a full catalogue page.
PAGE_SIZE = 500

# Yearly partitions of the history tables.
FIRST_YEAR = 2000
LAST_YEAR = 2026

# Defaults of the backfills. The weather ledger marks a whole range with year 0.
START_YEAR = 2000
END_YEAR = 2024
START_DATE = "2000-01-01"
WHOLE_RANGE_YEAR = 0
