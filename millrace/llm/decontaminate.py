"""Benchmark decontamination on templates, with DataFrame functions only.

Texts become templates: numbers, names and units turn into typed placeholders, letters
into lower case, everything else into single spaces. A name is a capitalised word inside
a sentence: what stands before its space is no full stop, question or exclamation mark.
Windows of ``WINDOW`` template words with ``LITERALS`` words or more that are no
placeholders are joined by hash. What stood at the placeholders must fit: along one
alignment of a document with an item, one value of the item must always meet one value
of the document. So a copy with other numbers or names is found, and a document that
only has the same phrases around unrelated values is not.

What that misses is looked for in three further ways. ``unnamed``: templates of texts in
lower case without names, for copies in any case and in any place of a sentence.
``linked``: a name at the start of a sentence counts if the text has it inside a sentence
too, and a row of names is one placeholder; the first word of an item is tried as a name as
well. Items without any window: their whole sequence of words. The three templates come from
one reading of a text, and its windows go through one lookup; where they are alike, as in a
text without names, they are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

WINDOW = 8
LITERALS = 4
#: Windows of an item that must be met: six make 13 words; shorter items need all.
NEEDED = 6
#: Window hashes that one scan of the documents broadcasts, 8 bytes each.
BROADCAST_HASHES = 1_000_000

# Markers of private use for numbers, names, units and decimal separators.
NUMBER, NAME, UNIT, POINT = "\ue000", "\ue001", "\ue002", "\ue003"
#: Another one, for capitalised words at the start of a sentence.
INITIAL = "\ue004"

# Units that may follow a number.
UNITS = (
    "mm cm dm km m in ft yd mi inch inches foot feet yard yards mile miles metre metres meter meters "
    "mg g kg t lb lbs oz gram grams pound pounds ounce ounces ton tons ml cl l litre litres liter liters "
    "gallon gallons s sec min h hr second seconds minute minutes hour hours day days week weeks month months "
    "year years hz khz mhz ghz w kw mw j kj v a k c f percent dollar dollars euro euros cent cents usd eur gbp "
    "kb mb gb tb mph kmh kph"
).split()

#: Replacements that mark placeholders and keep their values, applied in this order. Each
#: starts with a narrow class of characters, and single spaces match none of them.
STEPS = [
    (r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " "),
    (r"([^.!?] )(\p{Lu}\p{Ll}+)", rf"$1{NAME}$2"),
    (r"([^.!?] )(\p{Lu}\p{Ll}+)", rf"$1{NAME}$2"),  # every other one of a row of names
    (r"([0-9])[.,]([0-9])", rf"$1{POINT}$2"),
    (rf"([0-9][0-9{POINT}]*)", rf"{NUMBER}$1"),
    (
        rf"({NUMBER}[0-9{POINT}]+) ?((?i:{'|'.join(UNITS)}))([^\p{{L}}\p{{N}}]|$)",
        rf"$1 {UNIT}$2$3",
    ),
]
#: What separates words once letters are in lower case; marks, other ASCII signs and the
#: blocks of Latin and general punctuation do, any other character is part of a word.
OTHER = r"[^ a-z0-9\x{C0}-\x{1FFF}\x{2C00}-\x{10FFFF}]+"
PLACEHOLDER = rf"([{NUMBER}-{UNIT}])[^ ]*"


def _marked_all(text: Column) -> Column:
    """The words of a text, separated by single spaces, each value behind its marker, and
    capitalised words at the start of a sentence behind theirs."""
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    out = F.regexp_replace(blank, " {2,}", " ")
    # All names at once: what stands before one is looked at and not used up.
    out = F.regexp_replace(out, r"(?<=[^.!?] )(\p{Lu}\p{Ll}+)", f"{NAME}$1")
    out = F.regexp_replace(out, r"(^ ?|[.!?] )(\p{Lu}\p{Ll}+)", f"$1{INITIAL}$2")
    for pattern, put in STEPS[3:]:
        out = F.regexp_replace(out, pattern, put)
    return _plain(out)


def marked(text: Column) -> Column:
    """The words of a text, separated by single spaces, each value behind its marker."""
    return F.translate(_marked_all(text), INITIAL, "")


def template(words: Column) -> Column:
    """Marked words with the values taken away."""
    return F.regexp_replace(words, PLACEHOLDER, "$1")


def _plain(out: Column) -> Column:
    """Lower case, single spaces for what separates words."""
    apart = F.regexp_replace(F.lower(out), OTHER, " ")
    return F.trim(F.regexp_replace(apart, " {2,}", " "))


#: Ways to look at a text, and the bit of each.
NAMED, UNNAMED, LINKED = 0, 1, 2


def _three_ways(df: DataFrame, key: str) -> DataFrame:
    """``(key, named, unnamed, linked)``: the words of each text in three ways, from one
    reading of it.

    ``named`` has names, numbers and units marked; ``unnamed`` is in lower case without
    names; ``linked`` marks names at the start of a sentence that occur inside one too, and
    has one placeholder for a row of names.
    """
    full = df.select(key, _marked_all(F.col("text")).alias("f"))
    f = F.col("f")
    unnamed = F.regexp_replace(
        F.translate(f, NAME + INITIAL, ""),
        rf"({NUMBER}[0-9{POINT}]+) ({'|'.join(UNITS)})(?= |$)",
        rf"$1 {UNIT}$2",
    )

    def behind(marker: str) -> Column:
        return F.regexp_extract_all(f, F.lit(f"{marker}([^ ]+)"), F.lit(1))

    rows = full.select(
        key, "f", unnamed.alias("unnamed"), F.array_intersect(behind(INITIAL), behind(NAME)).alias("both")
    )
    # Words have no signs that mean something in a pattern.
    pattern = F.concat(F.lit(f"{INITIAL}("), F.array_join("both", "|"), F.lit(")(?= |$)"))
    resolved = F.when(F.size("both") > 0, F.regexp_replace(f, pattern, F.lit(f"{NAME}$1"))).otherwise(f)
    one_row = F.regexp_replace(F.translate(resolved, INITIAL, ""), rf"({NAME}[^ ]*) (?={NAME})", "$1-")
    return rows.select(key, F.translate(f, INITIAL, "").alias("named"), "unnamed", one_row.alias("linked"))


def _variants(df: DataFrame, key: str) -> DataFrame:
    """``(key, ways, m)``: the different ones of the three ways, with the bits of the ways
    that each stands for."""
    same_unnamed, same_linked = F.col("unnamed") == F.col("named"), F.col("linked") == F.col("named")
    bits = F.lit(1 << NAMED) + F.when(same_unnamed, 1 << UNNAMED).otherwise(0) + F.when(same_linked, 1 << LINKED).otherwise(0)
    found = F.array(
        F.struct(bits.alias("ways"), F.col("named").alias("m")),
        F.when(~same_unnamed, F.struct(F.lit(1 << UNNAMED).alias("ways"), F.col("unnamed").alias("m"))),
        F.when(~same_linked, F.struct(F.lit(1 << LINKED).alias("ways"), F.col("linked").alias("m"))),
    )
    return _three_ways(df, key).select(key, F.explode(F.array_compact(found)).alias("v")).select(key, "v.*")


def _windows(marked_words: DataFrame) -> DataFrame:
    """Rows with marked words ``m``: every window, its place and hash and what stood there."""
    others = [c for c in marked_words.columns if c != "m"]
    words = marked_words.select(
        *others, F.split("m", " ").alias("values"), F.split(template(F.col("m")), " ").alias("words")
    )
    # A condition on the number of words below the generator, stated or inferred, would
    # make every text a template twice; the outer form has its condition above it.
    at = F.explode_outer(
        F.when(F.size("words") >= WINDOW, F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)))
    )
    placed = words.select(*others, "values", "words", at.alias("at")).filter("at IS NOT NULL")
    hashed = F.xxhash64(*[F.element_at("words", F.col("at") + i) for i in range(WINDOW)])
    return placed.select(*others, "at", hashed.alias("h"), "values", "words")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``(item, way, at, h, values, words)``: the windows of the items that count, for each
    way of looking at them; ``item`` holds the item_id and the way.

    Items of fewer than ``WINDOW`` words have none. Rows without item_id take no part.
    """
    items = benchmark.filter("item_id IS NOT NULL").select("item_id", "text")
    # A comma before the first word of an item makes it a name, which counts when linked.
    twice = items.select("item_id", F.explode(F.array("text", F.concat(F.lit(", "), F.col("text")))).alias("text"))
    twice = twice.select(F.struct("item_id", F.col("text").startswith(", ").alias("begins")).alias("k"), "text")
    begins = F.coalesce("k.begins", F.lit(False))
    each = F.explode(
        F.array(
            F.when(~begins, F.struct(F.lit(NAMED).alias("way"), F.col("named").alias("m"))),
            F.when(~begins, F.struct(F.lit(UNNAMED).alias("way"), F.col("unnamed").alias("m"))),
            F.struct(F.lit(LINKED).alias("way"), F.col("linked").alias("m")),
        )
    )
    ways = _three_ways(twice, "k").select("k", begins.alias("begins"), each.alias("v")).filter("v IS NOT NULL")
    keyed = ways.select(F.struct("k.item_id", "v.way", "begins").alias("item"), F.col("v.way").alias("way"), "v.m")
    windows = _windows(keyed).select(
        "item",
        "way",
        "at",
        "h",
        F.slice("values", F.col("at"), WINDOW).alias("values"),
        F.slice("words", F.col("at"), WINDOW).alias("words"),
    )
    literals = F.size(F.filter("words", lambda w: ~w.rlike(f"^[{NUMBER}-{UNIT}]")))
    return windows.filter(literals >= LITERALS).dropDuplicates(["item", "at", "h"])


def _found(docs: DataFrame, items: DataFrame) -> DataFrame:
    """What ``judged`` says of the documents' windows that items have."""
    hashes = items.select("h").distinct()
    blocks = max(1, -(-hashes.count() // BROADCAST_HASHES))
    windows = _windows(_variants(docs.filter("doc_id IS NOT NULL"), "doc_id"))
    hits = None
    for block in range(blocks):
        these = hashes.filter(F.pmod("h", F.lit(blocks)) == block)
        found = windows.join(F.broadcast(these), "h", "left_semi").select(
            "doc_id", "ways", "at", "h", F.slice("values", F.col("at"), WINDOW).alias("values")
        )
        hits = found if hits is None else hits.union(found)
    return judged(hits, items)


def _whole(docs: DataFrame, items: DataFrame) -> DataFrame | None:
    """Documents that hold all words of an item in a row; None if there are no items."""
    text = _plain(F.coalesce("text", F.lit("")))
    theirs = items.select("item_id", F.split(text, " ").alias("item_words"), text.alias("t"))
    theirs = stored(
        theirs.filter("t <> ''").select(
            "item_id", "item_words", F.size("item_words").alias("n")
        ).distinct(),
        "whole-items",
    )
    least = theirs.agg(F.min("n")).first()[0]
    if least is None:
        return None
    # A place is looked up by the hash of as many words as the shortest item has.
    theirs = theirs.withColumn("h", F.xxhash64(F.slice("item_words", 1, least)))
    words = docs.filter("doc_id IS NOT NULL").select("doc_id", F.split(text, " ").alias("words"))
    placed = words.select("doc_id", "words", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("at"))
    begin = F.slice("words", F.col("at"), F.lit(least))
    return (
        placed.select("doc_id", "words", "at", F.xxhash64(begin).alias("h"))
        .join(theirs, "h")
        .filter(F.slice("words", F.col("at"), F.col("n")) == F.col("item_words"))
        .select(
            "doc_id",
            "item_id",
            F.lit(1).cast("bigint").alias("windows"),
            F.lit(1).cast("bigint").alias("item_windows"),
            F.lit(True).alias("same_values"),
        )
        .distinct()
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, windows, item_windows, same_values)`` for each leaked item.

    ``windows``: places of the item that consistent alignments with the document meet;
    ``same_values``: whether all values are the item's own. The figures are those of the
    templates with names; where these don't find the item, of the further way that meets
    most windows; an item without windows counts as one. Null and empty texts match
    nothing. Rows without doc_id or item_id take no part; rows that share a doc_id
    count as one document. Empty tables give an empty table.
    """
    items = stored(item_windows(benchmark), "item-windows")
    found = _found(docs, items).select(
        "doc_id", "item.item_id", "windows", "item_windows", "same_values",
        F.when(F.col("item.way") == NAMED, 1).otherwise(0).alias("way"),
    )
    plain = items.filter(F.col("way") == UNNAMED).select("item.item_id")
    bare = benchmark.filter("item_id IS NOT NULL").join(plain, "item_id", "left_anti")
    whole = _whole(docs, bare)
    if whole is not None:
        found = found.union(whole.withColumn("way", F.lit(0)))
    best = F.struct("way", "windows", "item_windows", "same_values")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"))
        .select("doc_id", "item_id", "best.windows", "best.item_windows", "best.same_values")
    )


def judged(hits: DataFrame, items: DataFrame) -> DataFrame:
    """Alignments of the hits whose values fit, and the items that enough of them meet."""
    theirs = items.select(
        "h", "item", "way", F.col("at").alias("item_at"), F.col("values").alias("item_values"), "words"
    )
    seen = F.col("ways").bitwiseAND(F.expr("shiftleft(1, way)")) != 0
    met = hits.join(theirs, "h").filter(seen).withColumn("shift", F.col("at") - F.col("item_at"))
    # One row for each value of the item, or one without value for a window without any.
    slots = F.filter(
        F.arrays_zip("words", "item_values", "values"),
        lambda x: x["words"].rlike(f"^[{NUMBER}-{UNIT}]"),
    )
    values = met.select(
        "doc_id", "item", "shift", "item_at", F.explode_outer(slots).alias("slot")
    )
    by_value = values.groupBy("doc_id", "item", "shift", "slot.item_values").agg(
        F.min("slot.values").alias("least"),
        F.max("slot.values").alias("most"),
        F.collect_set("item_at").alias("places"),
    )
    by_shift = by_value.groupBy("doc_id", "item", "shift").agg(
        F.bool_and(F.col("least").eqNullSafe(F.col("most"))).alias("fits"),
        F.bool_and(F.col("least").eqNullSafe(F.col("item_values"))).alias("same"),
        F.flatten(F.collect_list("places")).alias("places"),
    )
    sizes = items.groupBy("item").agg(F.countDistinct("at").alias("item_windows"))
    return (
        by_shift.filter("fits")
        .groupBy("doc_id", "item")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("bigint").alias("windows"),
            F.bool_and("same").alias("same_values"),
        )
        .join(sizes, "item")
        .filter(F.col("windows") >= F.least(F.col("item_windows"), F.lit(NEEDED)))
        .select("doc_id", "item", "windows", "item_windows", "same_values")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item; rows without doc_id stay."""
    gone = contaminated(docs, benchmark).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def oracle() -> str:
    """The same in SQL, windows compared as texts."""
    out = "coalesce(text, '')"
    for pattern, put in STEPS:
        put = put.replace("$", "\\")
        out = f"regexp_replace({out}, '{pattern}', '{put}', 'g')"
    apart = f"regexp_replace(lower({out}), '{OTHER}', ' ', 'g')"
    words = f"trim(regexp_replace({apart}, ' {{2,}}', ' ', 'g'))"
    plain = PLACEHOLDER.replace("$", "\\")

    def windows(name: str, key: str, source: str) -> str:
        return f"""{name}_marked AS (SELECT {key}, {words} AS m FROM {source} WHERE {key} IS NOT NULL),
{name}_words AS (SELECT {key}, string_split(m, ' ') AS v,
    string_split(regexp_replace(m, '{plain}', '\\1', 'g'), ' ') AS w FROM {name}_marked),
{name}_at AS (SELECT {key}, v, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS pos
    FROM {name}_words WHERE len(w) >= {WINDOW}),
{name} AS (SELECT {key}, pos, v[pos:pos + {WINDOW - 1}] AS v, w[pos:pos + {WINDOW - 1}] AS w FROM {name}_at)"""

    slot = f"regexp_matches(x, '^[{NUMBER}-{UNIT}]')"
    return f"""WITH {windows("i_all", "item_id", "benchmark")},
i AS (SELECT DISTINCT * FROM i_all WHERE len(list_filter(w, lambda x: NOT {slot})) >= {LITERALS}),
{windows("d", "doc_id", "documents")},
met AS (SELECT d.doc_id, i.item_id, d.pos - i.pos AS shift, i.pos, i.w, i.v AS iv, d.v AS dv
    FROM d JOIN i ON d.w = i.w),
slots AS (SELECT doc_id, item_id, shift, iv[k] AS a, dv[k] AS b
    FROM (SELECT *, unnest(range(1, {WINDOW + 1})) AS k FROM met) WHERE {slot.replace("(x", "(w[k]")}),
kinds AS (SELECT doc_id, item_id, shift, bool_and(least = most) AS fits, bool_and(least = a) AS same
    FROM (SELECT doc_id, item_id, shift, a, min(b) AS least, max(b) AS most FROM slots GROUP BY ALL)
    GROUP BY ALL),
sizes AS (SELECT item_id, count(DISTINCT pos) AS item_windows FROM i GROUP BY ALL)
SELECT doc_id, item_id, windows, item_windows, same_values FROM (
    SELECT doc_id, item_id, count(DISTINCT pos) AS windows, bool_and(coalesce(same, true)) AS same_values
    FROM met LEFT JOIN kinds USING (doc_id, item_id, shift) WHERE coalesce(fits, true) GROUP BY ALL
) JOIN sizes USING (item_id) WHERE windows >= least(item_windows, {NEEDED})"""
