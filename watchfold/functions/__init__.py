"""Column -> Column helpers shared by batch and streaming queries."""

from watchfold.functions.net import extract_ip, in_cidr, is_private
from watchfold.functions.rules import (
    flag_names,
    flag_text,
    keyword_hit,
    risk_tier,
    suspicious_domain,
    suspicious_uri,
    syn_only,
    uri_rule,
)
from watchfold.functions.text import clean_utf8, strip
from watchfold.functions.times import epoch_seconds, ssh_time, web_time

__all__ = [
    "clean_utf8",
    "epoch_seconds",
    "extract_ip",
    "flag_names",
    "flag_text",
    "in_cidr",
    "is_private",
    "keyword_hit",
    "risk_tier",
    "ssh_time",
    "strip",
    "suspicious_domain",
    "suspicious_uri",
    "syn_only",
    "uri_rule",
    "web_time",
]
