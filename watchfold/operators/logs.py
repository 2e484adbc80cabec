"""Web-server and ssh log lines into log entries."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold.functions.net import IP, extract_ip
from watchfold.functions.text import strip
from watchfold.functions.times import stamp_time, year_text

# User-facing names of the formats.
ALIASES = {
    "apache": "apache_combined",
    "apache2": "apache_combined",
    "apache_combined": "apache_combined",
    "apache_common": "apache_common",
    "nginx": "nginx_default",
    "nginx_default": "nginx_default",
    "nginx_upstream": "nginx_upstream",
    "ssh": "ssh_failed",
    "ssh_failed": "ssh_failed",
    "ssh_accepted": "ssh_accepted",
    "generic": "generic",
    "auto": "auto",
}

# One pass of one pattern covers all formats. The web formats share everything up to
# the size, and their two possible tails are optional look-aheads.
_WEB = (
    rf"(?<ip>{IP})\s+(?=(?<anonymous>-\s+-\s+\[)?)\S+\s+\S+\s+"
    r"\[(?=(?:(?<day>\d{1,2})/(?<month>[A-Za-z]{3})/(?<year>\d{4}):(?<clock>\d{1,2}:\d{1,2}:\d{1,2})[\s\]])?)"
    r"(?<stamp>[^\]]+)\]\s+"
    r'"(?<method>\S+)\s+(?<path>\S+)\s+\S+"\s+(?<status>\d{3})\s+(?<size>\d+|-)'
    r'(?=(?:\s+"[^"]*"\s+(?<combined>")(?<agent>[^"]*)")?)'
    r'(?=(?:\s+\S+\s+\S+\s+(?<upstream>")(?<agent2>[^"]*)")?)'
)
_SSH = (
    r"(?<stamp2>(?<month2>[A-Z][a-z]{2})\s+(?<day2>\d+)\s+(?<clock2>\d+:\d+:\d+))\s+\S+\s+sshd\[\d+\]:\s+"
    r"(?:(?<failed>Failed)\s+password\s+for\s+(?:invalid\s+(?:user\s+)?)?"
    r"|(?<accepted>Accepted)\s+(?:publickey|password)\s+for\s+)"
    rf"(?<user>\S+)\s+from\s+(?<ip2>{IP})"
)
_LINE = rf"(?s)^(?:{_WEB}|{_SSH}).*$"

# What a match is rearranged to. Groups that took no part are empty, so that two
# groups side by side give whichever matched.
_FIELDS = {
    "ip": "${ip}${ip2}",
    "stamp": "${stamp}${stamp2}",
    "year": "${year}",
    "month": "${month}${month2}",
    "day_time": "${day}${day2} ${clock}${clock2}",
    "login": "${failed}${accepted}",
    "anonymous": "${anonymous}",
    "combined": "${combined}",
    "agent": "${agent}",
    "upstream": "${upstream}",
    "agent2": "${agent2}",
    "user": "${user}",
    "method": "${method}",
    "path": "${path}",
    "status": "${status}",
    "size": "${size}",
}
_INDEX = {name: i + 1 for i, name in enumerate(_FIELDS)}

# Every group is named, so its number is its place. Java looks numbers up faster.
_GROUPS = {name: str(i + 1) for i, name in enumerate(re.findall(r"\(\?<([a-z]\w*)>", _LINE))}
_PACKED = "".join(
    "\n" + re.sub(r"\{(\w+)\}", lambda m: _GROUPS[m[1]], field) for field in _FIELDS.values()
)

# Detection order: the first format that matches names the line.
_ORDER = (
    "apache_combined",
    "nginx_default",
    "nginx_upstream",
    "apache_common",
    "ssh_failed",
    "ssh_accepted",
)


def _field(name: str, fields: str = "_fields") -> Column:
    """One field of the match: NULL if the line did not match, empty if it had none."""
    return F.get(fields, F.lit(_INDEX[name]))


def _tests() -> dict[str, Column]:
    """Whether the line matches each format; NULL or FALSE if not."""
    web = _field("status") != ""
    return {
        "apache_combined": _field("combined") != "",
        "nginx_default": web & (_field("anonymous") != ""),
        "nginx_upstream": _field("upstream") != "",
        "apache_common": web,
        "ssh_failed": _field("login") == "Failed",
        "ssh_accepted": _field("login") == "Accepted",
        "generic": F.lit(False),
    }


def _matched(lines: DataFrame) -> DataFrame:
    """Adds the line's ``_fields``, an array of one if no format matches.

    A line holds no line feed, so one that shows up marks a match and separates
    the fields.
    """
    raw = F.col("raw")
    broken = raw.contains("\n") | raw.contains("\r")
    line = F.when(broken, F.translate(raw, "\r\n", "  ")).otherwise(raw)
    return lines.withColumn("_fields", F.split(F.regexp_replace(line, _LINE, _PACKED), "\n"))


def _detected() -> Column:
    tests = _tests()
    return F.coalesce(*[F.when(tests[f], F.lit(f)) for f in _ORDER], F.lit("generic"))


def detect_format(lines: DataFrame) -> DataFrame:
    """Adds ``format``: the first format in detection order that a line matches."""
    return _matched(lines).withColumn("format", _detected()).drop("_fields")


def file_formats(lines: DataFrame) -> DataFrame:
    """``file_path, file_format``: the format of each file's first line.

    Lines without numbers, which have no first one, fail the job.
    """
    missing = F.raise_error(F.lit("detect='file' needs numbered lines")).cast("bigint")
    first = lines.filter(F.coalesce("line_number", missing) == 1)
    return detect_format(first).select("file_path", F.col("format").alias("file_format"))


def _addressed(lines: DataFrame, fmt: str, detect: str, strict: bool) -> DataFrame:
    """Lines with the format that counts, its fields and the address ``_ip``."""
    if fmt not in ALIASES:
        raise ValueError(f"unknown log format {fmt!r}, expected one of {sorted(ALIASES)}")
    if detect not in ("line", "file"):
        raise ValueError(f"detect must be 'line' or 'file', not {detect!r}")
    fmt = ALIASES[fmt]
    matched = _matched(lines)
    if fmt != "auto":
        chosen = F.when(_tests()[fmt], fmt).otherwise("generic")
    elif detect == "file":
        # One row per file on the right; no hint, so its size decides the join.
        matched = matched.join(file_formats(lines), "file_path", "left")
        tests = _tests()
        options = [F.when((F.col("file_format") == f) & tests[f], F.lit(f)) for f in _ORDER]
        chosen = F.coalesce(*options, F.lit("generic"))
    else:
        chosen = _detected()
    matched = matched.withColumn("_format", chosen)
    named = F.col("_format") != "generic"
    if strict:
        # an address cut out of a longer run of digits does not count
        address = extract_ip(F.when(named, _field("ip")).otherwise(F.col("raw")), True)
    else:
        address = F.when(named, _field("ip")).otherwise(extract_ip(F.col("raw")))
    return matched.withColumn("_ip", address)


def _entries(found: DataFrame, kept: list[str], year: int | Column | None) -> DataFrame:
    kind = F.col("_e._format")

    def field(name: str) -> Column:
        return F.nullif(_field(name, "_e._fields"), F.lit(""))

    agent = F.when(kind == "apache_combined", _field("agent", "_e._fields"))
    agent = agent.when(kind == "nginx_upstream", _field("agent2", "_e._fields"))
    return found.select(
        *kept,
        strip(F.col("raw")).alias("raw"),
        kind.alias("format"),
        stamp_time(F.coalesce(field("year"), year_text(year)), field("month"), field("day_time")).alias(
            "event_time"
        ),
        field("stamp").alias("timestamp_raw"),
        F.col("_e._ip").alias("ip_address"),
        field("status").try_cast("int").alias("status_code"),
        field("size").try_cast("bigint").alias("response_size"),
        agent.alias("user_agent"),
        field("user").alias("username"),
        F.lower(field("login")).alias("login_status"),
        field("method").alias("http_method"),
        field("path").alias("request_path"),
    )


def parse_logs(
    lines: DataFrame,
    fmt: str = "auto",
    detect: str = "line",
    year: int | Column | None = None,
    strict: bool = False,
) -> DataFrame:
    """Log entries of all lines that hold an address; other input columns stay.

    ``fmt`` names a format or alias. With ``auto`` each line is tried against all
    formats; ``detect='file'`` lets the first line of a file decide for the file.
    A line that does not match its format keeps its address and has NULL fields.
    ``year`` is assumed for ssh times, which carry none. Works on streams, except
    for ``detect='file'``.
    """
    found = _addressed(lines, fmt, detect, strict)
    kept = [c for c in lines.columns if c != "raw"]
    # The generator drops lines without an address. A filter would be pushed below
    # the projections and so run every pattern a second time.
    fields = F.when(F.col("_format") != "generic", F.col("_fields")).alias("_fields")
    entry = F.struct("_format", "_ip", fields)
    one = F.when(F.col("_ip").isNotNull(), F.array(entry))
    return _entries(found.select(*kept, "raw", F.explode(one).alias("_e")), kept, year)


def rejects(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Lines with neither a known format nor an address."""
    found = _addressed(lines, "auto", "line", strict)
    none = F.when(F.col("_ip").isNull(), F.array(F.lit(True)))
    return found.select(*lines.columns, F.explode(none).alias("_none")).drop("_none")


def failed_logins(entries: DataFrame) -> DataFrame:
    """Failed ssh logins and web requests answered with 401."""
    return entries.filter((F.col("login_status") == "failed") | (F.col("status_code") == 401))
