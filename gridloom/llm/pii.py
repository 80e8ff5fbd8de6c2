"""Personal data, and words that give it away.

Direct identifiers are found by pattern and check. Words are judged by what they disclose: an entity c (an identifier's
value) carries IC(c) = -log p(c); a word t near it carries PMI(c; t) = log p(c | t) / p(c), with document frequencies
over the whole corpus. A word whose PMI reaches ``DISCLOSURE`` of IC(c) for any entity discloses it and is protected
wherever it occurs: generalised to its kind of word, or removed if it reaches ``REMOVAL``. What few places tell is
smoothed: p(c | t) counts 1 - 2^-k of itself if the word stands near the entity in k different surroundings, so each
halves the doubt and copies of one text count as one. In a large corpus a word that stands by one address only, there
once, discloses it; in a small one it needs more places.

All of it is expressions and joins. Positions come from splitting a text at its matches: a match begins after the
parts and matches before it. The patterns are written so that no match tries a place twice: a run is taken whole
(possessive) and begins where a run or the last match ends.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bind, text_of
from gridloom.session import settle

#: Words on each side of an identifier that count as near.
NEAR = 8
#: Shares of an entity's information at which a word is generalised, and at which it is removed.
DISCLOSURE, REMOVAL = 0.9, 0.98

#: The four kinds in order, as patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM = r"[\p{L}\p{N}]+"
#: Positions are summed in runs of so many matches.
RUN = 256
#: Words listed for texts, in all, up to which Spark may broadcast the lists (some 50 bytes a word).
LISTED = 100_000


def _digits(value: Column) -> Column:
    return F.translate(value, "+ ().-", "")


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.negative(i), F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: bind(F.ltrim(p, F.lit("0")), lambda n: (F.length(n) < 3) | ((F.length(n) == 3) & (n <= "255"))))
    if kind == "card":
        return bind(_digits(value), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _starts(steps: Column) -> Column:
    """Sums of the steps before each, in runs: neither one long sum per element nor a growing array."""

    def add(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def all_of(s: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / RUN).cast("int")), lambda r: add(F.slice(s, r * RUN + 1, F.lit(RUN))))

        def one(runs: Column) -> Column:
            def before(_: Column, i: Column) -> Column:
                run = F.floor(i / RUN).cast("int")
                return add(F.slice(runs, F.lit(1), run)) + add(F.slice(s, run * RUN + 1, i - run * RUN))

            return F.transform(s, before)

        return bind(runs, one)

    return bind(steps, lambda s: F.when(F.size(s) > 0, all_of(s)).otherwise(F.array().cast("array<int>")))


def occurrences(text: Column, pattern: str) -> Column:
    """All matches as ``array<struct<at, start, end, value>>`` in code points, and the parts between, as ``parts``."""

    def place(x: Column) -> Column:
        steps = F.zip_with(F.slice(x["parts"], F.lit(1), F.size(x["hits"])), x["hits"], lambda p, h: F.length(p) + F.length(h))
        found = bind(
            _starts(steps),
            lambda s: F.transform(
                x["hits"],
                lambda h, i: bind(F.get(s, i) + F.length(F.get(x["parts"], i)), lambda b: F.struct(i.alias("at"), b.alias("start"), (b + F.length(h)).alias("end"), h.alias("value"))),
            ),
        )
        return F.struct(found.alias("found"), x["parts"].alias("parts"))

    return bind(F.struct(F.split(text, pattern, -1).alias("parts"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")), place)


def terms_of(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


SPANS = "array<struct<kind: string, start: int, end: int, value: string, near: array<string>>>"


def identifiers(text: Column) -> Column:
    """Valid matches of the four kinds, by kind and start, each with the words near it."""

    def of(kind: str) -> Column:
        def with_words(o: Column) -> Column:
            ok = F.filter(o["found"], lambda f: valid(kind, f["value"]))

            def one(f: Column) -> Column:
                left, right = terms_of(F.get(o["parts"], f["at"])), terms_of(F.get(o["parts"], f["at"] + 1))
                near = F.concat(bind(left, lambda w: F.slice(w, F.greatest(F.lit(1), F.size(w) - NEAR + 1), F.lit(NEAR))), F.slice(right, 1, NEAR))
                return F.struct(F.lit(kind).alias("kind"), f["start"].alias("start"), f["end"].alias("end"), f["value"].alias("value"), near.alias("near"))

            return F.transform(ok, one)

        possible = text.rlike("[0-9]") if kind != "email" else F.lit(True)
        if NEEDS[kind]:
            possible = F.contains(text, F.lit(NEEDS[kind])) & possible
        return F.when(possible, bind(occurrences(text, PATTERNS[kind]), with_words)).otherwise(F.array().cast(SPANS))

    return F.concat(*[of(k) for k in PATTERNS])


def entity(span: Column) -> Column:
    value = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``term, share``: words that disclose an entity, with the largest share of its information.

    ``docs`` has ``text``; ``found`` the settled ``spans`` per document. Sums run on (entity, word) pairs near each
    other and on words per document, both combined before they are shuffled.
    """
    near = found.select(F.monotonically_increasing_id().alias("doc"), F.explode("spans").alias("span")).select(
        "doc", entity(F.col("span")).alias("entity"), F.xxhash64("span.near").alias("around"), F.array_distinct("span.near").alias("near")
    )
    # One entity may stand in a third of all documents: count documents and surroundings by plain sums of distinct rows.
    pairs = near.select("doc", "entity", "around", F.explode("near").alias("term")).where("length(term) > 1")
    seen = pairs.groupBy("entity", "term", "around", "doc").agg(F.lit(1).alias("n"))
    by_around = seen.groupBy("entity", "term", "around").agg(F.count(F.lit(1)).alias("docs"))
    both = by_around.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("arounds"), F.sum("docs").alias("together"))
    candidates = settle(both)
    if candidates.isEmpty():
        return candidates.select("term", F.lit(1.0).alias("share"))
    carriers = near.select("doc", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"))
    # A common word is near many entities: written, the counts meet them in a join that can split it. Pairs and
    # entities are many and their files small, as words and values repeat: Spark would broadcast them.
    words = settle(docs.select(F.explode(F.array_distinct(terms_of(text_of()))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("with_term")))
    total = F.lit(float(docs.count()))
    scored = candidates.join(carriers.hint("merge"), "entity").join(words.hint("merge"), "term")
    # Several surroundings in one document count the document more than once; a word is in no more than hold it.
    joint = F.least("together", "with_entity", "with_term")
    sure = 1 - F.pow(F.lit(2.0), -F.col("arounds"))
    pmi = F.log(sure * joint * total / (F.col("with_entity") * F.col("with_term")))
    information = F.log(total / F.col("with_entity"))
    share = F.when(information > 0, pmi / information).otherwise(F.lit(0.0))
    return scored.withColumn("share", share).where(F.col("share") >= DISCLOSURE).groupBy("term").agg(F.max("share").alias("share"))


TERM_SPANS = "array<struct<kind: string, start: int, end: int, value: string>>"


def find(docs: DataFrame, name: str = "spans") -> DataFrame:
    """``docs`` plus the column ``name`` (in place of one of that name): ``array<struct<kind, start, end, value>>`` of identifiers and disclosing words.

    Identifiers come first by kind and start, then the words (kind ``term`` if generalised, ``removed`` if removed) by
    start. Null and empty texts have none. Rows with equal or null ids are searched each for itself; other columns stay.
    An empty table gives none.
    """
    with_spans = docs.withColumn("_gl_spans", identifiers(text_of()))
    found = settle(with_spans.select(F.col("_gl_spans").alias("spans")).where("size(spans) > 0"))
    terms = settle(disclosing_terms(docs.select("text"), found))
    base = F.transform("_gl_spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    if terms.isEmpty():
        return with_spans.withColumn(name, base).drop("_gl_spans")
    # A text's words are looked up once per word; the text's hash leads back to it. Should two texts share a hash, each
    # is offered the other's words too, which are protected wherever they occur.
    key = F.xxhash64(text_of())
    held = docs.select(key.alias("_gl_key"), F.explode(F.array_distinct(terms_of(text_of()))).alias("term"))
    listed = settle(held.join(terms, "term").groupBy("_gl_key").agg(F.collect_set(F.struct("term", (F.col("share") >= REMOVAL).alias("gone"))).alias("_gl_terms")))
    # In a file a word of a list is a byte or two, so that Spark takes long lists to be small.
    if (listed.agg(F.sum(F.size("_gl_terms"))).first()[0] or 0) > LISTED:
        listed = listed.hint("merge")

    def term_spans(terms: Column) -> Column:
        def named(s: Column) -> Column:
            gone = F.exists(terms, lambda t: (t["term"] == F.lower(s["value"])) & t["gone"])
            return F.struct(F.when(gone, "removed").otherwise("term").alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))

        hits = bind(occurrences(text_of(), TERM), lambda o: F.filter(o["found"], lambda s: F.exists(terms, lambda t: t["term"] == F.lower(s["value"]))))
        return F.transform(hits, named)

    joined = with_spans.withColumn("_gl_key", key).join(listed, "_gl_key", "left")
    extra = F.when(F.col("_gl_terms").isNull(), F.array().cast(TERM_SPANS)).otherwise(term_spans(F.col("_gl_terms")))
    by_kind = bind(extra, lambda e: F.concat(F.filter(e, lambda s: s["kind"] == "term"), F.filter(e, lambda s: s["kind"] == "removed")))
    return joined.withColumn(name, F.concat(base, by_kind)).drop("_gl_spans", "_gl_key", "_gl_terms")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span in place of its kind, removed words of nothing; overlapping spans go as one."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        overlaps = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] > s["start"])
        return F.when(overlaps, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))).otherwise(F.array_append(done, s))

    merged = F.aggregate(ordered, F.array().cast("array<struct<start: int, end: int, kind: string>>"), merge)

    def build(m: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            begin = F.when(i == 0, F.lit(0)).otherwise(F.get(m, i - 1)["end"])
            label = F.when(s["kind"] == "removed", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
            return F.concat(F.substring(text, begin + 1, s["start"] - begin), label)

        rest = F.substr(text, F.element_at(m, -1)["end"] + 1)
        return F.when(F.size(m) == 0, text).otherwise(F.concat(F.array_join(F.transform(m, piece), ""), rest))

    return bind(merged, build)


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with redacted texts; null texts stay null."""
    safe = find(docs, "_gl_found").withColumn("text", redacted(F.col("text"), F.col("_gl_found")))
    return safe.select(*docs.columns)
