"""IP address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The octet grammar decides which digits of a longer run are taken.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
IPV4 = rf"(?:{OCTET}\.){{3}}{OCTET}"

PRIVATE_RANGES = ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8")


_GROUP = "[0-9A-Fa-f]{1,4}"
# Fixed value: the first group of link-local addresses (fe80::/10), which may name a zone.
_LINK_LOCAL = "[fF][eE][89ABab][0-9A-Fa-f]"


def _compressions(groups: int, tail: str, first: str = _GROUP) -> list[str]:
    """Texts of ``groups`` groups and a tail, with ``::`` somewhere or nowhere.

    The tail follows a colon; without one the last group ends the text. ``::`` after n
    leading groups stands for one group at least.
    """
    more = rf"(?::{_GROUP})"
    if tail:
        forms = [rf"{first}{more}{{{groups - 1}}}:{tail}"]
        forms += [rf"{first}{more}{{{n - 1}}}::(?:{_GROUP}:){{0,{groups - 1 - n}}}{tail}" for n in range(1, groups)]
        return [*forms, rf"::(?:{_GROUP}:){{0,{groups - 1}}}{tail}"] if first == _GROUP else forms
    forms = [rf"{first}{more}{{{groups - 1}}}"]
    forms += [rf"{first}{more}{{{n - 1}}}:{more}{{1,{groups - 1 - n}}}" for n in range(1, groups - 1)]
    forms += [rf"{first}{more}{{0,{groups - 2}}}::"]
    return [*forms, rf":{more}{{1,{groups - 1}}}", "::"] if first == _GROUP else forms


def _ipv6_pattern() -> str:
    """All textual IPv6 forms as one token: neither side may touch a word or colon.

    The boundaries make ``std::map`` no address. The last 32 bits may be a dotted quad behind
    any prefix, and any link-local form may name its zone; these come first, as the
    other alternatives would end before the dot or the percent sign.
    """
    forms = _compressions(6, IPV4)
    forms.append(rf"(?:{'|'.join(_compressions(8, '', _LINK_LOCAL))})%[0-9A-Za-z]+")
    forms += _compressions(8, "")
    return rf"(?<![0-9A-Za-z:.])(?:{'|'.join(forms)})(?![0-9A-Za-z:])"


IPV6 = _ipv6_pattern()
IP = rf"(?:{IPV4}|{IPV6})"
STRICT_IP = rf"(?:(?<![0-9.]){IPV4}(?![0-9])(?!\.[0-9])|{IPV6})"


def extract_ip(text: Column, strict: bool = False) -> Column:
    """First IPv4 or IPv6 address in a text, NULL if there is none.

    The default takes an IPv4 address out of a longer run of digits as well;
    ``strict`` asks for a boundary on both sides.
    """
    return F.nullif(F.regexp_extract(text, STRICT_IP if strict else IP, 0), F.lit(""))


def _cidr_pattern(cidr: str) -> str:
    """Dotted quads of a network: fixed octets, the values of a partial one, any octets."""
    network, bits = cidr.split("/")
    octets, whole, rest = network.split("."), int(bits) // 8, int(bits) % 8
    parts = octets[:whole]
    if rest:
        low = int(octets[whole])
        values = range(low, low + (1 << 8 - rest))
        parts = [*parts, f"(?:{'|'.join(map(str, values))})"]
    return r"\.".join(parts + [OCTET] * (4 - len(parts)))


def in_cidr(ip: Column, *cidrs: str) -> Column:
    """Whether a dotted quad lies in one of the networks; FALSE if it is no dotted quad."""
    pattern = "|".join(_cidr_pattern(c) for c in cidrs)
    return F.coalesce(ip.rlike(f"^(?:{pattern})$"), F.lit(False))


def is_private(ip: Column) -> Column:
    """Whether an address is private or loopback; unparsable ones are not."""
    return in_cidr(ip, *PRIVATE_RANGES)


def address_digits(ip: Column) -> Column:
    """An address as hexadecimal digits: 8 for IPv4, 32 for IPv6, NULL for other texts.

    IPv6 texts may be compressed, end in a dotted quad and name a zone, which is left out.
    """
    quad = F.regexp_extract(ip, rf"({IPV4})$", 1)
    octets = F.transform(F.split(quad, r"\."), lambda x: F.lpad(F.hex(x.cast("bigint")), 2, "0"))
    four = F.array_join(octets, "")
    # a dotted quad at the end is two groups
    tail = F.concat(F.substring(four, 1, 4), F.lit(":"), F.substring(four, 5, 4))
    text = F.regexp_replace(ip, "%.*$", "")
    text = F.when(quad != "", F.concat(F.substring(text, F.lit(1), F.length(text) - F.length(quad)), tail)).otherwise(text)

    def groups(part: Column) -> Column:
        return F.transform(F.filter(F.split(part, ":"), lambda x: x != ""), lambda x: F.lpad(F.upper(x), 4, "0"))

    halves = F.split(text, "::")
    left, right = groups(halves[0]), F.when(F.size(halves) > 1, groups(F.get(halves, F.lit(1)))).otherwise(F.array())
    zeros = F.array_repeat(F.lit("0000"), 8 - F.size(left) - F.size(right))
    six = F.array_join(F.concat(left, zeros, right.cast("array<string>")), "")
    return F.when(ip.rlike(rf"^{IPV4}$"), four).when(ip.rlike(rf"^{IPV6}$"), six)


def masked_digits(digits: Column, length: Column) -> Column:
    """The first ``length`` bits of an address as digits, the last digit filled up with zeros."""
    whole, rest = F.floor(length / 4).cast("int"), F.pmod(length, F.lit(4))
    digit = F.conv(F.substring(digits, whole + 1, F.lit(1)), 16, 10).cast("int")
    # the highest bits of the digit: what is below their weight goes
    weight = F.element_at(F.array(*[F.lit(w) for w in (16, 8, 4, 2)]), rest.cast("int") + 1)
    kept = F.when(rest > 0, F.hex((digit - F.pmod(digit, weight)).cast("bigint"))).otherwise("")
    return F.concat(F.substring(digits, F.lit(1), whole), kept)
