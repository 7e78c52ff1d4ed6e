"""Personal data: fixed shapes, and terms that give away where they occur.

Base spans are four fixed shapes. The method then asks what else discloses a
protected entity of such a kind: over the corpus, a term's information about the
kind is its pointwise mutual information, log P(kind | term) / P(kind), and the
most any term can disclose is the kind's own information, -log P(kind). A term
that reaches the share ``DISCLOSE`` of that, in documents of at least ``SUPPORT``
different texts, is a span of kind ``term`` in every document that holds an entity
of the kind. ``sanitised`` generalises entities to their kind and removes terms.

All of it is built-in functions. Counts cover all documents; each task sums its
terms before the shuffle. Copies count once towards the support, which is the exact
number of distinct text hashes. Documents are searched for entities once.

Defined results: a null or empty text has no span; repeated rows give the same
spans each; an empty table gives no row. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.storage import materialized

# Fixed shapes: values that must match. Possessive quantifiers and the look-behinds only keep the
# matcher from trying starts inside a run that has failed as a whole; \G is the end of the last match.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9]){13,}+"  # matches of fewer digits would be dropped
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"(?<![\p{L}\p{M}\p{N}@._%+-])\p{L}{2,}+(?![\p{M}\p{N}@_%+-]|\.[\p{L}\p{N}])"
KINDS = ("email", "ip", "card", "phone", "term")
BASE = KINDS[:4]

#: Share of a kind's information from which a term discloses it.
DISCLOSE = 0.8
#: Different texts (told by hash) in which a term must occur with the kind.
SUPPORT = 5

SPAN = "array<struct<start:int,kind:int,end:int>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _small(part: Column) -> Column:
    """At most 255, with any number of leading zeros."""
    number = F.ltrim(part, F.lit("0"))
    return (F.length(number) <= 3) & (F.coalesce(number.try_cast("int"), F.lit(0)) <= 255)


def _luhn(digits: Column) -> Column:
    def weigh(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    weighed = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(weighed, F.lit(0), lambda acc, d: acc + d) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(found, r"\."), _small)
    if kind == "card":
        return let(_digits(found), lambda d: F.length(d).between(14, 19) & _luhn(d))
    if kind == "phone":
        return F.length(_digits(found)).between(10, 15)
    return F.lit(True)


def _located(text: Column, pattern: str, number: int, keep) -> Column:
    """Spans of the matches that pass ``keep``: gaps and matches alternate, so positions are running lengths."""
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPAN).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        at = acc["at"] + F.length(pair["gap"])
        end = at + F.length(pair["found"])
        span = F.struct(at.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        out = F.when(keep(pair["found"]), F.array_append(F.coalesce(acc["out"], F.array().cast(SPAN)), span)).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    def spans(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        pairs = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), F.coalesce(m, F.lit("")).alias("found")))
        # the gap after the last match is padded with an empty match, which isn't kept
        return F.aggregate(pairs, start, lambda acc, p: step(acc, p))["out"]

    none = F.array().cast(SPAN)
    return let(F.regexp_extract_all(text, F.lit(pattern), 0), lambda m: F.when(F.size(m) > 0, F.coalesce(spans(m), none)).otherwise(none))


def _keeper(kind: str):
    return lambda m: (m != "") & _valid(kind, m)


def base_spans(text: Column) -> Column:
    """All base spans in order of start, then kind. A text without a kind's own character is not searched for it."""
    patterns = {"email": (EMAIL, "@"), "ip": (IP, "."), "card": (CARD, None), "phone": (PHONE, "+")}
    parts = []
    for number, kind in enumerate(BASE):
        pattern, sign = patterns[kind]
        found = _located(text, pattern, number, _keeper(kind))
        parts.append(F.when(F.instr(text, sign) > 0, found).otherwise(F.array().cast(SPAN)) if sign else found)
    return F.array_sort(F.concat(*parts))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: Column, number: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def terms(text: Column) -> Column:
    """The different words of a text that are no part of an address or a number."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), 0))


def _search(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("text").alias("th"), base_spans(F.col("text")).alias("base"))


def _flags(spans: Column) -> list[Column]:
    return [(_count(spans, k) > 0).cast("int").alias(f"has_{kind}") for k, kind in enumerate(BASE)]


def _found(docs: DataFrame) -> DataFrame:
    """doc_id, th, base, and the text of documents with an entity: of others nothing but the counts is needed again."""
    return materialized(_search(docs).select("doc_id", "th", "base", F.when(F.size("base") > 0, F.col("text")).alias("text")), "pii-base")


def disclosing_terms(docs: DataFrame, disclose: float = DISCLOSE, support: int = SUPPORT, found: DataFrame | None = None) -> DataFrame:
    """kind (number), term, share: terms whose information about a kind reaches ``disclose`` of its own.

    Different texts are counted exactly, over (term, text) pairs of the documents that hold an
    entity; how often a term occurs at all is summed in each task over all documents.
    """
    found = _found(docs) if found is None else found
    total = found.select(*_flags(F.col("base"))).agg(F.count(F.lit(1)).alias("all_n"), *[F.sum(f"has_{k}").alias(f"all_{k}") for k in BASE])
    holding = found.where(F.size("base") > 0).select("th", *_flags(F.col("base")), F.explode(terms(F.col("text"))).alias("term"))
    by_text = holding.groupBy("term", "th").agg(*[F.sum(f"has_{k}").alias(f"n_{k}") for k in BASE])
    texts = [F.count_if(F.col(f"n_{k}") > 0).alias(f"texts_{k}") for k in BASE]
    counted = by_text.groupBy("term").agg(*[F.sum(f"n_{k}").alias(f"n_{k}") for k in BASE], *texts)
    counted = counted.where(F.greatest(*[F.col(f"texts_{k}") for k in BASE]) >= support)
    every = docs.select(F.explode(terms(F.coalesce(F.col("text"), F.lit("")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(f"n_{k}").alias("both"), F.col(f"texts_{k}").alias("texts"), F.col(f"all_{k}").alias("kind_n")) for i, k in enumerate(BASE)]))
    # one row of totals
    pairs = every.join(counted, "term").join(F.broadcast(total)).select("term", "n", "all_n", each.alias("x"))
    information = F.log2(F.col("all_n") / F.col("x.kind_n"))
    mutual = F.log2(F.col("x.both") * F.col("all_n") / (F.col("n") * F.col("x.kind_n")))
    pairs = pairs.where(F.col("x.texts") >= support).where(information > 0)
    return pairs.where(mutual >= disclose * information).select(F.col("x.kind").alias("kind"), "term", (mutual / information).alias("share"))


def sanitised(text: Column, spans: Column) -> Column:
    """Entities become their kind in brackets, terms go; of overlapping spans the first one counts."""
    names = F.array(*[F.lit(f"[{k}]") for k in BASE], F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        part = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), part.alias("out"))).otherwise(acc)

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def personal_data(docs: DataFrame, disclose: float = DISCLOSE, support: int = SUPPORT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, and the sanitised text where it differs."""
    found = _found(docs)
    risky = materialized(disclosing_terms(docs, disclose, support, found), "pii-disclosing")
    holding = found.where(F.size("base") > 0)
    # entities of a kind in a document, and the disclosing terms of that kind it holds
    kinds = F.array_distinct(F.transform("base", lambda s: s["kind"]))
    words = holding.select("doc_id", "th", kinds.alias("kinds"), F.explode(terms(F.col("text"))).alias("term"))
    held = words.join(risky.groupBy("term").agg(F.collect_set("kind").alias("of")), "term").where(F.arrays_overlap("kinds", "of"))
    held = held.groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).agg(F.collect_set("term").alias("risky"))
    joined_up = holding.join(held, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th")), "left")
    added = _located(F.col("text"), TERM, 4, lambda m: F.array_contains(F.col("risky"), F.lower(m)))
    none = F.array().cast(SPAN)
    more = F.when(F.col("risky").isNotNull(), added).otherwise(none)
    full = joined_up.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"), "text")
    rest = found.where(F.size("base") == 0).select("doc_id", "base", none.alias("spans"), F.lit(None).cast("string").alias("text"))
    every = full.union(rest)
    return every.select(
        "doc_id",
        *[_count(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(BASE)],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.when(F.size("spans") > 0, sanitised(F.col("text"), F.col("spans"))).alias("sanitised"),
    )
