"""Hosts with ``xn--`` labels in their written form, as column expressions.

The decoding of RFC 3492 is a fold over the characters behind a label's last hyphen; the numbers
in its state stay below 2**37, so it cannot overflow. What is no valid encoding stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siteledger.functions.urls import let

# The parameters of RFC 3492, section 5.
BASE, T_MIN, T_MAX, SKEW, DAMP, FIRST_BIAS, FIRST_CODE = 36, 1, 26, 38, 700, 72, 128
_LARGEST = (1 << 31) - 1
_DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"

_STATE = "struct<out: array<int>, i: bigint, code: bigint, bias: bigint, weight: bigint, k: bigint, old: bigint, bad: boolean>"


def _state(out: Column, **numbers: Column | int) -> Column:
    names = ("i", "code", "bias", "weight", "k", "old")
    return F.struct(
        out.cast("array<int>").alias("out"),
        *[(v if isinstance(v, Column) else F.lit(v)).cast("bigint").alias(n) for n, v in ((n, numbers[n]) for n in names)],
        F.coalesce(numbers.get("bad", F.lit(False)), F.lit(True)).alias("bad"),
    )


def _div(a: Column, b: Column | int) -> Column:
    return F.floor(a / b)


def _adapted(delta: Column, points: Column, first: Column) -> Column:
    """The bias after a number: section 6.1."""
    halved = F.when(first, _div(delta, DAMP)).otherwise(_div(delta, 2))
    start = let(halved, lambda d: d + _div(d, points))
    limit = (BASE - T_MIN) * T_MAX // 2
    # 35 ** 6 is beyond what a delta can be, so six steps do
    return F.aggregate(
        F.array(*[F.lit(0)] * 6),
        F.struct(start.alias("delta"), F.lit(0).cast("bigint").alias("k")),
        lambda s, _: F.when(
            s["delta"] > limit,
            F.struct(_div(s["delta"], BASE - T_MIN).alias("delta"), (s["k"] + BASE).alias("k")),
        ).otherwise(s),
        lambda s: s["k"] + _div((BASE - T_MIN + 1) * s["delta"], s["delta"] + SKEW),
    )


def _step(s: Column, char: Column) -> Column:
    digit = F.instr(F.lit(_DIGITS), char) - 1

    def read(digit: Column) -> Column:
        i = s["i"] + digit * s["weight"]
        least = F.least(F.greatest(s["k"] - s["bias"], F.lit(T_MIN)), F.lit(T_MAX))
        points = F.size(s["out"]) + 1

        def ended(i: Column) -> Column:
            at = i % points
            code = s["code"] + _div(i, points)
            out = F.concat(F.slice(s["out"], 1, at.cast("int")), F.array(code.cast("int")), F.slice(s["out"], at.cast("int") + 1, F.size(s["out"])))
            unfit = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
            return F.when(unfit, _bad(s)).otherwise(
                _state(out, i=at + 1, code=code, bias=_adapted(i - s["old"], points, s["old"] == 0), weight=1, k=BASE, old=at + 1)
            )

        weight = s["weight"] * (BASE - least)
        more = _state(s["out"], i=i, code=s["code"], bias=s["bias"], weight=weight, k=s["k"] + BASE, old=s["old"], bad=weight > _LARGEST)
        return (
            F.when((digit < 0) | (i > _LARGEST), _bad(s))
            .when(digit < least, F.aggregate(F.array(i), F.lit(None).cast(_STATE), lambda _, v: ended(v)))
            .otherwise(more)
        )

    return F.when(s["bad"], s).otherwise(F.aggregate(F.array(digit), F.lit(None).cast(_STATE), lambda _, v: read(v)))


def _bad(s: Column) -> Column:
    return _state(s["out"], i=0, code=0, bias=0, weight=0, k=0, old=0, bad=F.lit(True))


def _decoded(label: Column) -> Column:
    """The written form of a lower-case label that begins with ``xn--``; NULL where it is no valid encoding."""
    plain = F.regexp_extract(label, "^xn--(.*)-[^-]*$", 1)
    encoded = F.regexp_extract(label, "^xn--(?:.*-)?([^-]*)$", 1)
    start = _state(
        F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: F.ascii(c)),
        i=0, code=FIRST_CODE, bias=FIRST_BIAS, weight=1, k=BASE, old=0,
    )

    def text(s: Column) -> Column:
        digits = F.array_join(F.transform(s["out"], lambda code: F.lpad(F.hex(code), 8, "0")), "")
        whole = ~s["bad"] & (s["weight"] == 1) & (s["k"] == BASE)
        return F.when(whole, F.decode(F.unhex(digits), "UTF-32"))

    valid = label.rlike("^xn--[\\x00-\\x7f]*[a-z0-9]$")
    chars = F.filter(F.split(encoded, ""), lambda c: c != "")
    return F.when(valid, F.aggregate(chars, start, _step, text))


def written_host(host: Column) -> Column:
    """A host with its ``xn--`` labels decoded, and nothing else changed; labels stay labels."""

    def written(label: Column) -> Column:
        decoded = let(_decoded(F.lower(label)), lambda d: F.when(~d.contains("."), d))
        return F.when(F.lower(label).startswith("xn--"), F.coalesce(decoded, label)).otherwise(label)

    labels = F.array_join(F.transform(F.split(host, r"\.", -1), written), ".")
    return F.when(host.rlike(r"(?i)(?:^|\.)xn--"), labels).otherwise(host)
