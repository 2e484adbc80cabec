"""Rule expressions: what counts as risky, private, suspicious."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# TCP flag bits
FIN, SYN, RST, PSH, ACK = 1, 2, 4, 8, 16

# Thresholds, word lists and rule texts that decide the results.
HIGH_RISK, MEDIUM_RISK = 80, 50
KEYWORDS = ("password", "credential", "secret", "key=", "token")
KEYWORD_PATTERN = "(?i)(password|credential|secret|key|token)"
SUSPICIOUS_TLDS = ("xyz", "top", "tk", "ml", "ga", "cf", "gq")
LONG_DOMAIN = 50
LONG_LABEL = 15
TRAVERSAL = ("../", "..\\")
SQL_INJECTION = ("' or '1'='1", "union select", "--", "/*", "drop table", "xp_cmdshell")
SHELLSHOCK = ("() {",)
COMMANDS = ("cmd.exe", "powershell", "/bin/sh")


def risk_tier(score: Column) -> Column:
    """HIGH, MEDIUM or LOW for an abuse confidence score."""
    return (
        F.when(score >= HIGH_RISK, "HIGH").when(score >= MEDIUM_RISK, "MEDIUM").otherwise("LOW")
    )


def syn_only(flag_bits: Column, protocol: Column) -> Column:
    """TCP packets that open a connection: SYN set, ACK clear."""
    return (protocol == "TCP") & (flag_bits.bitwiseAND(SYN | ACK) == SYN)


# Flag names and the bits each needs, in display order; SYN-ACK needs both.
FLAG_NAMES = (
    ("SYN", SYN),
    ("SYN-ACK", SYN | ACK),
    ("ACK", ACK),
    ("PSH", PSH),
    ("FIN", FIN),
    ("RST", RST),
)


def flag_names(flag_bits: Column) -> Column:
    """Names of the flags that are set, as an array."""
    names = [F.when(flag_bits.bitwiseAND(m) == m, name) for name, m in FLAG_NAMES]
    return F.array_compact(F.array(*names))


def flag_text(flag_bits: Column) -> Column:
    """Flag names joined by commas, empty if none is set."""
    return F.array_join(flag_names(flag_bits), ",")


def keyword_hit(text: Column) -> Column:
    """First sensitive keyword, in list order, that a text contains; else NULL."""
    lowered = F.lower(text)
    return F.coalesce(*[F.when(lowered.contains(k), F.lit(k)) for k in KEYWORDS])


def suspicious_domain(domain: Column) -> Column:
    """Long name, a long label that is mostly digits, or a risky top-level domain."""

    def machine_made(label: Column) -> Column:
        digits = F.length(F.regexp_replace(label, r"\P{Nd}", ""))
        return (
            (F.length(label) > LONG_LABEL)
            & F.replace(label, F.lit(" "), F.lit("")).rlike(r"^[\p{L}\p{N}]+$")
            & (digits * 2 > F.length(label))
        )

    # Only names with a long enough label reach the per-label test.
    labelled = domain.rlike(rf"[^.]{{{LONG_LABEL + 1},}}") & F.exists(
        F.split(domain, r"\."), machine_made
    )
    risky_tld = F.lower(domain).rlike(rf"\.(?:{'|'.join(SUSPICIOUS_TLDS)})$")
    return F.coalesce((F.length(domain) > LONG_DOMAIN) | risky_tld | labelled, F.lit(False))


def uri_rule(uri: Column) -> Column:
    """Name of the first rule that a request URI breaks, NULL if it breaks none."""
    lowered = F.lower(uri)

    def any_of(text: Column, needles: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])

    return (
        F.when(any_of(uri, TRAVERSAL), "path_traversal")
        .when(any_of(lowered, SQL_INJECTION), "sql_injection")
        .when(any_of(uri, SHELLSHOCK), "shellshock")
        .when(any_of(lowered, COMMANDS), "command_execution")
    )


def suspicious_uri(uri: Column) -> Column:
    """Whether a request URI breaks any rule."""
    return uri_rule(uri).isNotNull()
