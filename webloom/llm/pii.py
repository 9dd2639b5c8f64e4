"""Personal data: patterns, then information-theoretic sanitisation of what gives entities away.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers; their values are the
protected entities. A term standing near an entity may identify it as well as its own value does. How
much it tells is estimated from the whole corpus: with c(t, e) the occurrences of term t within
`reach` words of entity e and c(t) all occurrences of t, the pointwise mutual information of t and e
is IC(e) + log2(c(t, e) / c(t)), where IC(e) is the information of e itself. A term that keeps a
share of at least `threshold` of IC(e) discloses e, and each of its occurrences in any text becomes a
span of kind term, with or without e beside it.

Rare words stand beside an entity by chance, too. Were terms dealt out at random, t would stand near e
in about m = c(t) * s(e) / N texts, with s(e) the places around e and N the places of the corpus, and
in k texts or more with probability at most exp(k - m) (m / k)^k. Of all N * E pairs of a place and an
entity less than `chance` may pass that way, or the pair tells nothing. Copies of a text count once.
A single text never suffices, whatever the corpus; two do in a very large one.

Texts are read three times: for patterns and the terms around them, to count the terms in question,
and to find every occurrence of the disclosing ones. Only the few candidate terms and spans travel,
unless the disclosing terms are too many to be broadcast.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import materialize, tune

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: An IP match starts where a run of digits starts: inside a run it would fail or succeed alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Terms: runs without white space and these signs.
TERM_BREAKS = ".,;:!?\"()"
_TERM = re.compile(r"[^\x20\x09-\x0D.,;:!?\"()]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping e-mail addresses, found from their @ signs in linear time."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            end = match.end()
        at = text.find("@", max(at + 1, end))
    return found


def _ip_ok(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in value.split("."))


def _card_ok(value: str) -> bool:
    digits = [int(c) for c in value if c not in " -"]
    if not 13 <= len(digits) <= 19:
        return False
    doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all base matches, by kind in the order of KINDS, then start."""
    if not text:
        return []
    spans = [("email", s, e) for s, e in emails(text)]
    if not _DIGIT.search(text):
        return spans
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _ip_ok(m[0])]
    spans += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if len(m[0]) >= 13 and _card_ok(m[0])]
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return spans


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def nearby_terms(text: str, spans, reach: int) -> list[tuple[int, str]]:
    """(entity, term) of every term within `reach` terms of a base span, none overlapping one.

    An entity is the hash of its kind and value, so all of its mentions share it.
    """
    if not spans:
        return []
    terms = [(m.start(), m.end()) for m in _TERM.finditer(text)]
    starts = [s for s, _ in terms]
    blocked = sorted((s, e) for _, s, e in spans)
    from bisect import bisect_left

    block_starts = [s for s, _ in blocked]
    ends_so_far, high = [], 0
    for _, e in blocked:
        high = max(high, e)
        ends_so_far.append(high)

    def free(s: int, e: int) -> bool:
        k = bisect_left(block_starts, e)
        return k == 0 or ends_so_far[k - 1] <= s

    out = []
    for kind, s, e in spans:
        value = text[s:e] if kind == "email" else "".join(c for c in text[s:e] if c not in " ()-")
        digest = hashlib.blake2b(f"{kind}:{value.lower()}".encode(), digest_size=8).digest()
        entity = int.from_bytes(digest, "little", signed=True)
        left, right = bisect_left(starts, s), bisect_left(starts, e)
        picked = []
        for order in (range(left - 1, -1, -1), range(right, len(terms))):
            n = 0
            for i in order:
                a, b = terms[i]
                if free(a, b):
                    picked.append((a, b))
                    n += 1
                if n == reach:
                    break
        out += [(entity, text[a:b].lower()) for a, b in picked]
    return out


FOUND = (
    "doc_id long, crc long, n_email long, n_ip long, n_card long, n_phone long, base string, n_chars long, "
    "near array<struct<entity: long, term: string>>"
)


def find_entities(docs: DataFrame, reach: int) -> DataFrame:
    """Base spans of each row and the terms around them."""

    def run(batches):
        near_type = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.string())]))
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                spans = base_spans(text)
                near = [{"entity": e, "term": t} for e, t in nearby_terms(text, spans, reach)] if spans else []
                counts = [sum(k == kind for k, _, _ in spans) for kind in KINDS]
                row = (doc_id, zlib.crc32((text or "").encode()), *counts, joined(spans), len(text or ""), near)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = [pa.int64()] * 6 + [pa.string(), pa.int64(), near_type]
            names = ["doc_id", "crc", "n_email", "n_ip", "n_card", "n_phone", "base", "n_chars", "near"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FOUND)


def _known(terms: DataFrame, broadcast_up_to: int) -> frozenset | None:
    """The distinct terms if they are few enough to go along with the code, else None."""
    return frozenset(r.term for r in terms.collect()) if terms.count() <= broadcast_up_to else None


def term_counts(docs: DataFrame, terms: DataFrame, broadcast_up_to: int = 50_000) -> DataFrame:
    """(term, n): occurrences in the whole corpus of the given distinct terms; a null term has all terms' number.

    Counts of a batch of texts are summed before they travel. Up to a checked number of terms only
    theirs do; beyond it all terms' counts are joined with them.
    """
    known = _known(terms, broadcast_up_to)

    def run(batches):
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                for t, n in Counter(_TERM.findall(text or "")).items():
                    low = t.lower()
                    counts[None] += n
                    if known is None or low in known:
                        counts[low] += n
            yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return counted if known is not None else counted.join(terms.withColumn("_wanted", F.lit(1)), "term", "left").where("term is null or _wanted = 1").drop("_wanted")


def _tells(n, n_entity, total, entities: int, threshold: float, chance: float) -> Column:
    """Whether n_near of a term's n occurrences, in n_texts texts, are too many around an entity to be an accident.

    Fewer occurrences and a larger corpus only make a pair tell more.
    """
    total = F.lit(float(max(2, total)))
    information = F.log2(total / n_entity)
    mutual = information + F.log2(F.least(F.col("n_near") / n, F.lit(1.0)))
    k, m = F.col("n_texts").cast("double"), n * n_entity / total
    accident = k - m + k * F.log(m / k) + F.log(total) + F.lit(math.log(entities))
    return (information > 0) & (mutual >= threshold * information) & (k > m) & (accident < F.lit(math.log(chance)))


def disclosing(found: DataFrame, docs: DataFrame, threshold: float, chance: float) -> DataFrame:
    """(entity, term) pairs whose mutual information is at least threshold of the entity's, and no accident.

    Only terms that might pass are counted in the corpus: a term occurs at least once in each row that
    has it near any entity, and a text has no more terms than every other character.
    """
    some = found.where(F.size("near") > 0).select("crc", "near")
    near = some.select("crc", F.explode("near").alias("x")).select("crc", "x.entity", "x.term")
    pairs = near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_near"), F.count_distinct("crc").alias("n_texts"))
    pairs = pairs.where("n_texts > 1")  # one text can't pass: its bound is e * E at least
    mentions = materialize(near.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")), "entity-mentions")
    rows = some.select(F.explode(F.array_distinct(F.transform("near", lambda x: x.term))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_rows"))
    most = found.agg(F.coalesce(F.sum(F.floor((F.col("n_chars") + 1) / 2)), F.lit(0))).first()[0]
    entities = max(1, mentions.count())
    might = pairs.join(rows, "term").join(mentions, "entity").where(_tells(F.col("n_rows"), F.col("n_entity"), most, entities, threshold, chance))
    might = materialize(might.drop("n_rows"), "term-pairs")
    counts = materialize(term_counts(docs, might.select("term").distinct()), "term-counts")
    total = counts.where("term is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return might.join(counts, "term").where(_tells(F.col("n"), F.col("n_entity"), total, entities, threshold, chance)).select("entity", "term")


def occurrences(text: str, known) -> list[tuple[str, int, int]]:
    """(term, start, end) of every occurrence of a known term (None: of every term), but those inside a base span."""
    if known is not None and text.isascii() and known.isdisjoint(_TERM.findall(text.lower())):
        return []
    found = [(t, m.start(), m.end()) for m in _TERM.finditer(text) if (t := m[0].lower()) and (known is None or t in known)]
    covered = [(s, e) for _, s, e in base_spans(text)] if found else []
    return [x for x in found if not any(s <= x[1] and x[2] <= e for s, e in covered)] if covered else found


def term_spans(docs: DataFrame, terms: DataFrame, broadcast_up_to: int = 50_000) -> DataFrame:
    """(doc_id, crc, start, stop): every occurrence of the given distinct terms in the whole texts.

    Up to a checked number of terms they are broadcast and only their occurrences travel; beyond it
    all terms of the texts are joined with them.
    """
    known = _known(terms, broadcast_up_to)

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = occurrences(text, known) if text else []
                crc = zlib.crc32(text.encode()) if found else 0
                for term, start, stop in found:
                    for column, value in zip(out, (doc_id, crc, term, start, stop), strict=True):
                        column.append(value)
            types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "crc", "term", "start", "stop"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = texts.mapInArrow(run, "doc_id long, crc long, term string, start int, stop int")
    return (spans if known is not None else spans.join(terms, "term", "left_semi")).drop("term")


def find_personal_data(docs: DataFrame, reach: int = 8, threshold: float = 0.95, chance: float = 0.01) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base, spans, crc for each row of docs (doc_id, text).

    base and spans are kind:start:end lists in code points; spans adds all occurrences of disclosing terms, wherever they stand. Null and
    empty texts have none. Repeated rows count as one text beside an entity and come out once each. A
    null doc_id is carried through. An empty table gives no rows.
    """
    tune(docs.sparkSession)
    found = materialize(find_entities(docs, reach), "entities")
    pairs = disclosing(found, docs, threshold, chance)
    terms = materialize(pairs.select("term").distinct(), "disclosing")
    hits = term_spans(docs, terms).groupBy("doc_id", "crc").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("terms"))
    listed = F.concat_ws(",", F.transform("terms", lambda t: F.concat_ws(":", F.lit(TERM), t.start.cast("string"), t.stop.cast("string"))))
    hits = hits.select(F.col("doc_id").alias("_id"), F.col("crc").alias("_crc"), listed.alias("_terms"))
    rows = found.drop("near", "n_chars").join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("crc") == F.col("_crc")), "left")
    spans = F.concat_ws(",", F.nullif("base", F.lit("")), F.col("_terms"))
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", spans.alias("spans"), "crc")


#: What stands in the text for a removed span: the entity's kind, or nothing that tells.
GENERAL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", TERM: "[...]"}


def redact(text: str, spans: str) -> str:
    """A text with each span generalised; of overlapping spans the one that starts first counts."""
    out, at = [], 0
    parsed = sorted((int(s), -int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x))
    for start, minus_end, kind in parsed:
        if start >= at:
            out += [text[at:start], GENERAL[kind]]
            at = -minus_end
        else:
            at = max(at, -minus_end)
    return "".join(out) + text[at:]


def sanitize(docs: DataFrame, **options) -> DataFrame:
    """docs with all personal data and disclosing terms in text generalised; other columns as they are."""
    spans = find_personal_data(docs, **options).where("spans <> ''").select("doc_id", "crc", "spans").distinct()
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), crc.alias("text_crc"), F.col("text").cast("string").alias("text"))
    joined_up = rows.join(spans, rows["id"].eqNullSafe(spans["doc_id"]) & (rows["text_crc"] == spans["crc"]), "left")

    @F.pandas_udf("string")
    def redacted(text, spans):
        import pandas as pd

        return pd.Series([t if not s else redact(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)

    out = joined_up.select("row", redacted("text", "spans").alias("text"))
    return out.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
