"""Personal data: patterns, and terms that reveal whom a pattern stands for. DataFrame functions only.

Base spans are e-mail and IP addresses, card and phone numbers, found leftmost and without overlap per kind; matches that fail
their test (Luhn, ranges, digits) are dropped without a retry. Equal values of a span are one protected entity.

Terms are the words of a text, of any length, outside its e-mail addresses. All counts are of distinct whole texts, so copies are no
evidence, while a signature in many texts is. With n(e) texts that hold an entity, n(e, t) of them with the term, n(t) texts
with the term and N texts in all,

    disclosure = PMI(e; t) / IC(e) = log(n(e, t) N / (n(e) n(t))) / log(N / n(e))

tells which part of the information about the entity the term gives away. In documents that hold the entity, a term that
reaches ``DISCLOSURE`` in at least ``SUPPORT`` texts is generalised to its first ``STEM`` letters, if all terms that share them
together stay below the threshold, and else removed.

Defined results: a null or empty text has no spans and stays as it is; a null id has base spans but no terms; rows
that repeat an id share its terms. Columns pass through; names this module adds replace columns of the same name.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.llm.storage import stored
from chatterlens.operators.joins import fits, sized_join

KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT = 3
DISCLOSURE = 0.85
STEM = 4
BROADCAST_CHARS = 8 << 20

# Possessive quantifiers and look-behinds give the same matches in time linear in the text.
LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"\p{L}++"
STEM_MARK = "\x01"


_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""
    def term(i: Column) -> Column:  # i-th digit from the right, from 0
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    places = F.sequence(F.lit(0), F.greatest(F.length(digits) - 1, F.lit(0)))
    return F.aggregate(places, F.lit(0), lambda s, i: s + term(i)) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.concat(F.lit("0"), F.right(p, F.lit(3))).cast("int") <= 255))
    if kind == "card":
        size = F.length(_digits(value))
        return F.when(size.between(12, 19), luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


#: Pattern of each kind and a cheap test that every text with a passing match meets.
PATTERNS = {
    "email": (EMAIL, lambda t: F.contains(t, F.lit("@"))),
    "ip": (IP, lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"))),
    "card": (CARD, lambda t: F.rlike(t, F.lit(r"[0-9](?:[\x20-]?[0-9]){11}"))),
    "phone": (PHONE, lambda t: F.contains(t, F.lit("+"))),
}


def _spans(gaps: Column, found: Column, kind: str) -> Column:
    """Spans ``(start, rank, end, kind, value)`` from the texts between matches and the matches."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def add(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gaps"])
        end = start + F.length(pair["found"])
        one = F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), pair["found"].alias("value")
        )
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    # the text behind the last match has no partner
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, f: F.struct(g.alias("gaps"), f.alias("found")))
    return F.when(F.size(found) > 0, F.aggregate(pairs, empty, add)["spans"]).otherwise(F.array().cast(_SPANS))


def with_base(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base``: all base spans, by start, then kind; offsets in code points, end exclusive."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = docs.withColumns({f"_found_{k}": F.when(may(text), F.regexp_extract_all(text, F.lit(p), F.lit(0))) for k, (p, may) in PATTERNS.items()})
    out = out.withColumns({
        f"_gaps_{k}": F.when(F.size(f"_found_{k}") > 0, F.split(text, p, -1)) for k, (p, _) in PATTERNS.items()
    })
    def passing(kind: str) -> Column:
        spans = F.filter(_spans(F.col(f"_gaps_{kind}"), F.col(f"_found_{kind}"), kind), lambda s: _passes(kind, s["value"]))
        return F.coalesce(spans, F.array().cast(_SPANS))

    out = out.withColumn("base", F.array_sort(F.concat(*[passing(k) for k in PATTERNS])))
    return out.drop(*[f"_{part}_{k}" for part in ("found", "gaps") for k in PATTERNS])


def terms(text: Column) -> Column:
    """The distinct words of a text and, behind ``STEM_MARK``, their distinct stems; no other kind of base span has letters."""
    outside = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, " ")).otherwise(text)
    found = F.array_distinct(F.regexp_extract_all(F.lower(outside), F.lit(WORD), F.lit(0)))
    return F.concat(found, F.array_distinct(F.transform(found, lambda t: F.concat(F.lit(STEM_MARK), F.left(t, F.lit(STEM))))))


def contexts(docs: DataFrame) -> DataFrame:
    """``(doc_id, whole, entities, terms)`` per document with a base span; equal texts have the same ``whole``."""
    spans = with_base(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    entities = F.array_distinct(F.transform("base", lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))))
    whole = F.struct(F.xxhash64("text").alias("hash"), F.length("text").alias("size"))
    return spans.where("size(base) > 0 AND doc_id IS NOT NULL").select("doc_id", whole.alias("whole"), entities.alias("entities"), terms(F.col("text")).alias("terms"))


def revealing(docs: DataFrame) -> DataFrame:
    """``(doc_id, term, stem)``: terms to take out of a document; ``stem`` is null where nothing of the term may stay."""
    found = stored(contexts(docs), "contexts")
    once = stored(found.groupBy("whole").agg(F.first("entities").alias("entities"), F.first("terms").alias("terms")), "once")
    frequent = once.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= SUPPORT)
    frequent = stored(frequent, "frequent")
    # a hot entity's texts must not gather in one task: broadcast after a count, else salted
    pairs = sized_join(once.select(F.explode("entities").alias("entity"), "terms"), frequent, ["entity"])
    pairs = pairs.select("entity", "n_e", F.explode("terms").alias("term")).groupBy("entity", "n_e", "term").agg(F.count("*").alias("n_et"))
    pairs = stored(pairs.where(F.col("n_et") >= SUPPORT), "pairs")

    texts = docs.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    counts = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    counts = stored(counts.where(F.col("n_t") >= SUPPORT), "terms")
    n = F.lit(float(max(docs.agg(F.count_distinct(F.xxhash64("text"), F.length("text"))).first()[0], 1)))

    def disclosure(joint: Column, alone: Column) -> Column:
        return F.log(joint * n / (F.col("n_e") * alone)) / F.log(F.greatest(n / F.col("n_e"), F.lit(1.0 + 1e-9)))

    # files of repeated words are far smaller than their rows in memory, so Spark must not choose a broadcast by them
    judged = stored(pairs.join(counts.hint("merge"), "term").withColumn("_strong", disclosure(F.col("n_et"), F.col("n_t")) >= DISCLOSURE), "judged")
    is_stem = F.col("term").startswith(STEM_MARK)
    strong = judged.where(~is_stem & F.col("_strong")).select("entity", "term", F.left("term", F.lit(STEM)).alias("stem"))
    stems = judged.where(is_stem).select("entity", F.substring("term", 2, STEM).alias("stem"), F.col("_strong").alias("_stem_strong"))
    general = ~F.col("_stem_strong") & (F.length("term") > STEM)
    out = stored(strong.join(stems.hint("merge"), ["entity", "stem"]).select("entity", "term", F.when(general, F.col("stem")).alias("stem")), "strong")
    held = sized_join(found.select("doc_id", F.explode("entities").alias("entity")).distinct(), out, ["entity"])
    return held.groupBy("doc_id", "term").agg(
        F.when(F.count("stem") == F.count("*"), F.max("stem")).alias("stem")
    )


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: base and term spans by start, then kind. A term span's value is what replaces it."""
    terms = revealing(docs).groupBy(F.col("doc_id").alias("_doc")).agg(F.map_from_entries(F.collect_list(F.struct("term", F.coalesce("stem", F.lit(""))))).alias("_terms"))
    terms = stored(terms, "revealing")
    terms = F.broadcast(terms) if fits(terms, max_chars=BROADCAST_CHARS) else terms.hint("merge")
    out = with_base(docs).join(terms, F.col("doc_id") == F.col("_doc"), "left").drop("_doc")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.array_sort(F.map_keys("_terms")), "|"), F.lit(r")(?!\p{L})"))
    out = out.withColumn("_pattern", F.when(F.size("_terms") > 0, pattern))
    out = out.withColumn("_found", F.when(F.col("_pattern").isNotNull(), F.regexp_extract_all(text, F.col("_pattern"), F.lit(0))))
    out = out.withColumn("_gaps", F.when(F.size("_found") > 0, F.split(text, F.col("_pattern"), -1)))
    found = F.transform(
        F.when(F.size("_found") > 0, _spans(F.col("_gaps"), F.col("_found"), "term")).otherwise(F.array().cast(_SPANS)),
        lambda s: s.withField("value", F.coalesce(F.col("_terms")[F.lower(s["value"])], F.lit(""))),
    )
    out = out.withColumn("spans", F.array_sort(F.concat("base", found)))
    return out.drop("_terms", "_pattern", "_found", "_gaps")


def digest(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(text: Column, spans: Column) -> Column:
    """The text with every span replaced: base spans by their kind, terms by their stem or ``<TERM>``.

    Of overlapping spans the first stands for all; a null text stays null.
    """
    def label(s: Column) -> Column:
        stem = F.when(s["value"] != "", F.concat(s["value"], F.lit("*"))).otherwise(F.lit("<TERM>"))
        return F.when(s["kind"] == "term", stem).otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))

    def add(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        between = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(fresh, F.concat(acc["out"], between, label(s))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    begun = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    # the rest is cut once at the end, so its length does not matter
    whole = F.aggregate(spans, begun, add, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with the text sanitised; other columns as they are."""
    kept = docs.columns
    return find(docs).withColumn("text", sanitised(F.col("text").cast("string"), F.col("spans"))).select(*kept)


def count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def summary(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``find``'s result."""
    return found.select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))
