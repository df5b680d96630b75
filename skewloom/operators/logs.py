"""Parse the lines of an application log; works on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The layout of a log line, and the message that names an application.
TIME = r"\d{4}-\d{2}-\d{2}[T ]\d{2}:?\d{2}(?::?\d{2}(?:[.,]\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?"
LEVEL = (
    r"[Aa]lert|ALERT|[Tt]race|TRACE|[Dd]ebug|DEBUG|[Nn]otice|NOTICE|[Ii]nfo|INFO|[Ww]arn(?:ing)?|WARN(?:ING)?"
    r"|[Ee]rr(?:or)?|ERR(?:OR)?|[Cc]rit(?:ical)?|CRIT(?:ICAL)?|[Ff]atal|FATAL|[Ss]evere|SEVERE|[Ee]merg|EMERG"
)
CLASS = r"[A-Za-z$_][A-Za-z$_0-9]*(?:\.[A-Za-z$_][A-Za-z$_0-9]*)*"
FIELDS = ("timestamp", "thread", "loglevel", "class", "component", "log_message")
LAUNCH = r"Asked to launch executor .*/[+-]?[0-9]+(?:\.[0-9]+)? for \b(\w+)\b"

_SEPARATOR = "\x01"


def line_pattern(spaces: str = " +") -> str:
    """The regular expression of a whole line; `spaces` is what separates level and class.

    The line starts with its time, and neither thread nor component holds a closing bracket: so each part has one place
    where it can end, and the time to match grows with the length of the line only.

    A level is padded to five letters, so one or more spaces follow it. Two exactly ("  ") would take only levels of
    four letters.
    """
    return (
        rf"(?s)\A({TIME}) \[([^\]\x01]*+)\] ({LEVEL}){spaces}({CLASS}) \[([^\]\x01]*+)\] - (.*+)\z"
    )


def parse_logs(lines: DataFrame, column: str = "value", spaces: str = " +") -> DataFrame:
    """Fields of each line, its event time as UTC without zone, its day, and whether it had the layout.

    A line without the layout stays, with `matched` false and null fields. The expression runs once per line: it
    rewrites the line into separated fields, which are then split; a line it does not fit comes back unchanged.
    """
    groups = _SEPARATOR.join(f"${n}" for n in range(1, len(FIELDS) + 1))
    cut = lines.withColumn("_cut", F.regexp_replace(F.col(column), line_pattern(spaces), groups))
    cut = cut.withColumn("matched", F.col("_cut") != F.col(column))
    cut = cut.withColumn("_part", F.when(F.col("matched"), F.split("_cut", _SEPARATOR, len(FIELDS))))
    fields = cut.select(
        *lines.columns,
        "matched",
        *[F.col("_part")[n].alias(name) for n, name in enumerate(FIELDS)],
    )

    clock = F.translate("timestamp", ",", ".")
    zoned = F.col("timestamp").rlike(r"(?:Z|[+-]\d{2}:?\d{2})$")
    to_utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), clock.try_cast("timestamp").cast("timestamp_ntz"))
    time = F.when(zoned, to_utc).otherwise(clock.try_cast("timestamp_ntz"))
    app = F.when(F.col("log_message").contains("Asked to launch executor"), F.regexp_extract("log_message", LAUNCH, 1))
    parsed = fields.withColumns({"event_time": time, "spark_app_name": F.nullif(app, F.lit(""))})
    return parsed.withColumn("day", F.translate(F.col("event_time").cast("date").cast("string"), "-", "."))
