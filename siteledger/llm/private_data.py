"""Personal data in texts: fixed forms, and what stands in the same contexts as they do."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteledger.llm.common import saved, slices

# Kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")

#: Distinct known identifiers that a context needs before it counts as a pattern.
MIN_SEEDS = 5
#: Score from which a pattern finds identifiers, and confidence from which a find is one.
MIN_SCORE, MIN_CONFIDENCE = 0.85, 0.85
#: Added to the number of identifiers of a context, so that few of them do not make a full score.
DOUBT = 0.5
#: What an unknown form that could be of a kind weighs beside known ones, and beside forms that cannot.
UNKNOWN = 0.1
ROUNDS = 3
#: Characters of a context word that are compared.
WORD_CHARS = 40

# No pattern reads any text twice: an address is looked for around its sign, runs of digits begin
# where a run begins, and repeats whose end is certain are possessive.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Loose forms of what the fixed ones miss.
_SIGN = re.compile(r"@|\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s(?=[A-Za-z0-9-]+\sdot\s)")
_LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|\s?[\[({<]\s?dot\s?[\])}>]\s?|\sdot\s)[A-Za-z0-9-]++)*+")
_NUMBERS = re.compile(r"[+(]?[0-9](?:[\x20().,:/_-]{0,2}[0-9])++")
_LOOSE_IP = re.compile(r"[0-9]{1,3}([.,:_-])[0-9]{1,3}(?:\1[0-9]{1,3}){2}")
_LOOSE_PHONE = re.compile(r"[+(]?[0-9][\x20()./0-9-]*[0-9]")
_LOOSE_CARD = re.compile(r"[0-9](?:[\x20._/-]?[0-9])++")
_EDGES = "\"'`.,;:!?()[]{}<>*#"

_SPAN = "struct<kind: int, start: int, end: int>"
_SEEN = "struct<start: int, end: int, form: bigint, base: int, loose: int, contexts: array<string>>"
_READ = f"row bigint, doc_id bigint, base array<{_SPAN}>, seen array<{_SEEN}>"


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(filter("0123456789".__contains__, text))


def _left_of(text: str, at: int, low: int) -> int:
    """Where the run of address characters that ends at ``at`` begins, not before ``low``."""
    while at > low and text[at - 1] in _LOCAL:
        at -= 1
    return at


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed forms: leftmost, not overlapping within a kind, in order of kind and start."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = _left_of(text, at, end)
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _digits(m[0])) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def loose_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, bits of kinds) of anything that could be an identifier of some kind, in a looser form; bits may be none."""
    end = 0
    for m in _SIGN.finditer(text):
        start = _left_of(text, m.start(), end)
        domain = _LOOSE_DOMAIN.match(text, m.end()) if start < m.start() else None
        if domain:
            end = domain.end()
            yield start, end, 1
    for m in _NUMBERS.finditer(text):
        digits = sum(map(m[0].count, "0123456789"))
        if digits >= 4:
            kinds = 2 if _LOOSE_IP.fullmatch(m[0]) else 0
            kinds |= 4 if 13 <= digits <= 19 and _LOOSE_CARD.fullmatch(m[0]) else 0
            kinds |= 8 if 7 <= digits <= 15 and _LOOSE_PHONE.fullmatch(m[0]) else 0
            yield *m.span(), kinds


_DIGIT = re.compile("[0-9]")


def _plain(word: str) -> str:
    return _DIGIT.sub("0", word.strip(_EDGES)[-WORD_CHARS:].lower())


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: the word before it, the two words before it, the words on both sides."""
    left = [w for w in map(_plain, text[max(0, start - 3 * WORD_CHARS) : start].split()[-3:]) if w][-2:]
    right = next((w for w in map(_plain, text[end : end + 2 * WORD_CHARS].split()[:2]) if w), "")
    out = [f"{left[-1]} *"] if left else []
    if len(left) > 1:
        out.append(f"{left[0]} {left[1]} *")
    if left and right:
        out.append(f"{left[-1]} * {right}")
    return out


def read_spans(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, seen): fixed forms, and every identifier-like span with its contexts. Written once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
        like = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("form", pa.int64()), ("base", pa.int32()), ("loose", pa.int32()), ("contexts", pa.list_(pa.string()))])
        for batch in slices(batches):
            bases, likes = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                seen = [(a, b, k, 0) for k, a, b in base]
                known = sorted((a, b) for _, a, b in base)
                at = 0
                for a, b, loose in sorted(loose_spans(text)):
                    while at < len(known) and known[at][1] <= a:
                        at += 1
                    if at == len(known) or known[at][0] >= b:
                        seen.append((a, b, -1, loose))
                bases.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
                likes.append([{"start": a, "end": b, "form": xxhash.xxh64_intdigest(text[a:b].lower()) - (1 << 63), "base": k, "loose": loose, "contexts": contexts(text, a, b)} for a, b, k, loose in seen])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(bases, pa.list_(kind)), pa.array(likes, pa.list_(like))], ["row", "doc_id", "base", "seen"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return saved(rows.mapInArrow(read, _READ), "spans")


def edges(spans: DataFrame) -> DataFrame:
    """(context, form, base, loose): the distinct pairs of the graph, whatever the number of copies of a text."""
    seen = spans.select(F.explode("seen").alias("s")).select(F.explode("s.contexts").alias("context"), "s.form", "s.base", "s.loose")
    # one form may be read differently in different places
    return seen.groupBy("context", "form").agg(F.max("base").alias("base"), F.bit_or("loose").alias("loose"))


def _is(kind: int) -> Column:
    return F.when(F.col("base") == kind, 1.0)


def _fits(kind: int) -> Column:
    return F.col("loose").bitwiseAND(1 << kind) != 0


def score(pairs: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE) -> tuple[DataFrame, DataFrame]:
    """Patterns (context, seeds, forms, p_<kind>...) and confidences of unknown forms (form, c_<kind>...) after some rounds.

    A pattern's score for a kind is the weight of its forms of that kind over the weight of all its forms,
    plus ``DOUBT``; it counts only with ``min_seeds`` known identifiers of the kind. Known identifiers,
    and forms that cannot be of the kind, weigh 1. An unknown form that has the kind's loose shape weighs
    ``UNKNOWN``, of which its confidence is for the pattern and the rest against it. That confidence is 0 at first,
    then that not all patterns around it with at least ``min_score`` err: one minus the product of their doubts.
    """
    patterns = forms = None
    pairs = saved(pairs, "pairs")
    for turn in range(rounds):
        now = pairs if forms is None else pairs.join(forms, "form", "left")
        sums = []
        for k, name in enumerate(KINDS):
            open_ = (F.col("base") < 0) & _fits(k)
            sure = F.lit(0.0) if forms is None else F.coalesce(F.col(f"c_{name}"), F.lit(0.0))
            sums += [
                F.sum(F.when(F.col("base") == k, 1.0).when(open_, UNKNOWN * sure).otherwise(0.0)).alias(f"p_{name}"),
                F.sum(F.when(open_, UNKNOWN).otherwise(1.0)).alias(f"w_{name}"),
                F.count(_is(k)).alias(f"s_{name}"),
            ]
        scored = now.groupBy("context").agg(F.count("*").alias("forms"), *sums)
        scored = scored.select("context", "forms", *[F.when(F.col(f"s_{n}") >= min_seeds, F.round(F.col(f"p_{n}") / (F.col(f"w_{n}") + DOUBT), 9)).otherwise(0.0).alias(f"p_{n}") for n in KINDS], *[f"s_{n}" for n in KINDS])
        patterns = saved(scored.where(F.greatest(*[F.col(f"p_{n}") for n in KINDS]) >= min_score), f"patterns-{turn}")
        unknown = pairs.where("base < 0 AND loose <> 0").join(patterns, "context")
        doubts = [F.sum(F.when(_fits(k) & (F.col(f"p_{n}") >= min_score), F.log1p(-F.col(f"p_{n}")))).alias(f"c_{n}") for k, n in enumerate(KINDS)]
        found = unknown.groupBy("form").agg(*doubts)
        forms = saved(found.select("form", *[F.round(1 - F.exp(F.coalesce(F.col(f"c_{n}"), F.lit(0.0))), 9).alias(f"c_{n}") for n in KINDS]), f"forms-{turn}")
    return patterns, forms


def _joined(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"])))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_private_data(docs: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Personal data of every document: (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, base, added).

    ``base`` holds (kind, start, end) of the fixed forms, in code points, end exclusive; the counts and
    ``base_sha256`` are of these. ``added`` holds what the contexts tell: the fixed forms are seeds, the words
    around them are patterns, and patterns and identifier-like spans (addresses with a written-out sign,
    numbers in other groupings or with a wrong check digit) score each other over the whole corpus
    (``score``). A span whose confidence for a kind reaches ``min_confidence`` is added wherever its form occurs,
    as its most likely kind; of overlapping ones the leftmost, then the longest stays.
    ``spans`` is all of them, by kind and start.

    Texts are read whole, once, where they lie. Only distinct pairs of context and form move, so copies
    of a text, however many, weigh as one; no vocabulary is broadcast or brought to the driver.

    Null texts are empty and have no spans. Rows come back one for one: repeated rows, null ids. An
    empty table gives no rows. Columns other than doc_id and text are not read.
    """
    spans = read_spans(docs)
    _, forms = score(edges(spans), rounds, min_seeds, min_score)
    best = F.greatest(*[F.col(f"c_{n}") for n in KINDS])
    kind = F.coalesce(*[F.when(F.col(f"c_{n}") == best, k) for k, n in enumerate(KINDS)])
    sure = forms.where(best >= min_confidence).select("form", kind.alias("kind"))
    unknown = spans.select("row", F.explode("seen").alias("s")).where("s.base < 0 AND s.loose <> 0").select("row", "s.start", "s.end", "s.form", "s.loose")
    found = unknown.join(sure, "form").where(F.expr("loose & shiftleft(1, kind)") != 0)
    listed = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(F.col("start"), (-F.col("end")).alias("back"), F.col("kind")))).alias("found"))  # of one document

    nothing = F.expr(f"CAST(array() AS array<{_SPAN}>)")
    # leftmost first: one that begins before the last one kept has ended falls out
    kept = F.aggregate(
        F.col("found"),
        nothing,
        lambda done, s: F.when((F.size(done) > 0) & (s["start"] < F.try_element_at(done, F.lit(-1))["end"]), done).otherwise(
            F.concat(done, F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), (-s["back"]).alias("end"))))
        ),
    )
    every = spans.select("row", "doc_id", "base").join(listed.select("row", kept.alias("added")), "row", "left").withColumn("added", F.coalesce("added", nothing))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, (lambda kind: lambda s: s == kind)(k))).cast("long").alias(f"n_{n}") for k, n in enumerate(KINDS)]
    return every.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", "added")).alias("spans"), "base", "added")
