"""Benchmark decontamination by templates: documents that repeat benchmark items, verbatim or with other numbers and names.

**Template.** White space is collapsed. Numbers, quantities (a number and its unit) and names (capitalised words inside a sentence) become one
placeholder each, typed by kind; other words are lower-cased, punctuation goes. Windows of ``width`` consecutive tokens are hashed and joined with the
windows of all items; template windows of fewer than ``width / 2`` plain words are no evidence. A second set of windows has no placeholders: words
and digits in lower case. It finds copies in another case and windows that are mostly numbers or names, both with the item's own values only.
An item shorter than ``width`` tokens is one window.

**Occurrences.** For matching template windows the slots' values are compared. A window without slots counts, and so does one with the item's own
values. Others count together with those of their occurrence, if in it an item's value stands for the same value of the document wherever it occurs.
An occurrence is an alignment of the item with the document (place in the document minus place in the item), or alignments that lie closer than
half the item (text was put in or left out), or the document; the one that gives most windows holds. A document
is contaminated by an item if at least ``evidence`` windows count, of the template or of the second set (all, if the item has fewer).

Only DataFrame and SQL functions are used. Windows of all texts are made and probed inside the scan when a count proves the items' windows
few; with more, both sides are exchanged by hash. Values are read again only from documents with a match.

**Result.** ``item_windows`` and ``n_windows`` are those of the template if it suffices, else of the second set (``slots_agree`` is then true).

**Cases.** Null and empty texts, and those without letters and digits, match nothing; an item of a word or two is found wherever these stand. Repeated rows and
ids give one result per document id and item. Empty tables give an empty result. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import sized
from tidemark.operators.scratch import written

#: Units that make a number a quantity (fixed values).
UNITS = (
    "mm|cm|m|km|in|ft|yd|mi|mg|g|kg|t|oz|lb|lbs|ml|cl|l|gal|s|sec|min|h|hr|hrs|hours?|minutes?|seconds?|days?|weeks?|months?|years?"
    "|meters?|metres?|miles?|feet|inches|grams?|kilograms?|pounds?|tons?|liters?|litres?|dollars?|euros?|cents?|percent|km/h|mph|kb|mb|gb|tb|w|kw|v|hz"
)
# What stands before is looked at behind the first character: most places fail on that one.
_EDGE = r"(?![\p{L}\p{N}])"
_NAME = r"\p{Lu}(?<=[\p{L}\p{N},;] \p{Lu})\p{Ll}+" + _EDGE
_NUMBER = r"[0-9](?<![\p{L}\p{N}][0-9])[0-9]*(?:[.,][0-9]+)*"
_QUANTITY = _NUMBER + rf" ?(?:(?:{UNITS}){_EDGE}|[%°€$£])"
_PLAIN = _NUMBER + _EDGE
NAME, NUMBER, QUANTITY = "\x01", "\x02", "\x03"


#: Characters that count as blanks: white space, and those that mark slots.
_BLANKS = "\x01\x02\x03\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Windows of templates, and of words without placeholders.
TEMPLATE, WORDS = 0, 1


def _clean(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, _BLANKS, " " * len(_BLANKS)), "  +", " ")


def template(text: Column) -> Column:
    """Tokens of a text with typed placeholders."""
    clean = F.regexp_replace(F.regexp_replace(_clean(text), _NAME, NAME), _QUANTITY, QUANTITY)
    clean = F.regexp_replace(clean, _PLAIN, NUMBER)
    return F.regexp_extract_all(F.lower(clean), F.lit("[\\p{L}\\p{N}]+|[\x01-\x03]"), F.lit(0))


def words(text: Column) -> Column:
    """Tokens of a text without placeholders."""
    return F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))


def slots(text: Column) -> Column:
    """The values behind the placeholders, in order; blanks and case do not count."""
    found = F.regexp_extract_all(_clean(text), F.lit(f"{_NAME}|{_QUANTITY}|{_PLAIN}"), F.lit(0))
    return F.transform(found, lambda x: F.lower(F.replace(x, F.lit(" "), F.lit(""))))


def hashed(tokens: Column) -> Column:
    """Each token as a number: windows overlap, so that a token would be read ``width`` times."""
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _runs(rows: DataFrame, codes: str, longest: int) -> DataFrame:
    """``rows`` with hashes of the runs of 2, 4, ... tokens that begin at each place, as columns beside ``codes`` (tokens as hashes).

    A run's hash is that of its halves. Columns, as an expression that is used twice would be evaluated twice.
    """
    length, shorter = 2, codes
    while length < longest:
        rows, shorter = rows.withColumn(f"{codes}_{length}", _joined(shorter, length // 2, None)), f"{codes}_{length}"
        length *= 2
    return rows


def _joined(half: str, apart: int, mark: int | None) -> Column:
    more = [] if mark is None else [F.lit(mark)]
    return F.transform(F.col(half), lambda x, i: F.xxhash64(x, F.get(F.col(half), i + apart), *more))


def _begun(codes: str, width: int, kind: int) -> Column:
    """Like ``windows``, with a hash for every place: the last ones, where no whole window begins, are of fewer runs and equal no window's."""
    mark, half = width << 1 | kind, 1 << max(0, (width - 1).bit_length() - 1)
    column = codes if half == 1 else f"{codes}_{half}"
    return _joined(column, width - half, mark) if width > 1 else F.transform(codes, lambda x: F.xxhash64(x, F.lit(mark)))


def windows(codes: str, width: int, kind: int) -> Column:
    """Hashes of all runs of ``width`` tokens by place: those of the two runs, of a power of two, that begin and end them (and may overlap)."""
    return F.slice(_begun(codes, width, kind), F.lit(1), F.greatest(F.size(codes) - (width - 1), F.lit(0)))


def _probes(keyed: DataFrame, made: list[tuple[int, int]], width: int) -> DataFrame:
    """``doc_id, key, n_tokens, n_words, pos, h``: for every kind and width of ``made``, one after the other, a hash for each token of the text.

    A text without windows has one row, with null as hash: the outer generator reads windows from a column as they are. Of the inner one Spark would
    derive a filter that makes all windows once more; and of windows made inside the generator each row would leave compiled code.
    """
    rows = keyed.withColumn("tokens", hashed(template(F.col("_text")))).withColumn("words", hashed(words(F.col("_text")))).drop("_text")
    rows = _runs(_runs(rows, "tokens", width), "words", width)
    every = F.flatten(F.array(*(_begun("words" if kind == WORDS else "tokens", n, kind) for kind, n in made)))
    rows = rows.select("doc_id", "key", F.size("tokens").alias("n_tokens"), F.size("words").alias("n_words"), every.alias("every"))
    return rows.select("doc_id", "key", "n_tokens", "n_words", F.posexplode_outer("every").alias("pos", "h"))


def _is_slot(token: Column) -> Column:
    return token.isin(NAME, NUMBER, QUANTITY)


def _values(tokens: Column, values: Column, at: Column, width: int) -> Column:
    """Values of the slots in the window that begins at ``at`` (from 0)."""
    before = F.size(F.filter(F.slice(tokens, F.lit(1), at), _is_slot))
    inside = F.size(F.filter(F.slice(tokens, at + 1, F.lit(width)), _is_slot))
    return F.slice(values, before + 1, inside)


def _item_windows(items: DataFrame, width: int) -> DataFrame:
    mine = items.select("item_id", F.col("text").alias("_text")).filter("_text IS NOT NULL")
    none = F.array().cast("array<string>")

    def of(kind: int, tokens: Column, values: Column) -> DataFrame:
        rows = mine.withColumn("tokens", tokens).withColumn("values", values).withColumn("length", F.size("tokens"))
        rows = _runs(rows.withColumn("codes", hashed(F.col("tokens"))), "codes", width)
        every = F.when(F.col("length") >= width, windows("codes", width, kind))
        for n in range(1, width):
            every = every.when(F.col("length") == n, windows("codes", n, kind))
        return rows.select("item_id", "tokens", "values", "length", F.lit(kind).alias("kind"), F.posexplode(every).alias("at", "h"))

    told = of(TEMPLATE, template(F.col("_text")), slots(F.col("_text")))
    plain = F.size(F.filter(F.slice("tokens", F.col("at") + 1, F.lit(width)), lambda t: ~_is_slot(t)))
    told = told.filter(plain * 2 >= width).withColumn("values", _values(F.col("tokens"), F.col("values"), F.col("at"), width))
    both = told.unionByName(of(WORDS, words(F.col("_text")), none)).select("item_id", "kind", "length", "at", "h", "values")
    return written(both.dropDuplicates(["item_id", "kind", "at", "h"]))


def _agreed(slotted: DataFrame) -> DataFrame:
    """``key, item_id, more``: the most windows besides free ones that an occurrence adds whose values agree.

    ``slotted`` has the template hits with slots: ``key, item_id, place, at, length, values, found, free``.
    """
    of = ["key", "item_id"]
    hit = slotted.withColumn("diagonal", F.col("place") - F.col("at"))
    # Alignments closer than half the item, but at least a window, make one run.
    by = Window.partitionBy(*of).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by) > F.greatest(F.col("reach"), F.col("length") / 2)
    runs = hit.groupBy(*of, "diagonal").agg(F.max("length").alias("length"), F.max("reach").alias("reach"))
    runs = runs.withColumn("run", F.sum(F.when(apart, 1).otherwise(0)).over(by)).select(*of, "diagonal", "run")
    levels = F.array(*(F.struct(F.lit(i).alias("level"), x.cast("long").alias("o")) for i, x in enumerate((F.col("diagonal"), F.col("run"), F.lit(0)))))
    hit = hit.join(runs, [*of, "diagonal"]).withColumn("occurrence", F.explode(levels))
    group = [*of, "occurrence"]
    told = hit.select(*group, F.explode(F.arrays_zip("values", "found")).alias("z")).select(*group, F.col("z.values").alias("v"), F.col("z.found").alias("f"))
    agree = told.distinct().groupBy(*group, "v").agg(F.count("*").alias("n")).groupBy(*group).agg(F.max("n").alias("n")).filter("n = 1")
    more = hit.groupBy(*group).agg(F.countDistinct(F.when(~F.col("free"), F.col("at"))).alias("more"))
    return more.join(agree, group, "left_semi").groupBy(*of).agg(F.max("more").alias("more"))


def contaminated(docs: DataFrame, items: DataFrame, width: int = 8, evidence: int = 5) -> DataFrame:
    """``doc_id, item_id, n_windows, item_windows, slots_agree`` for every contaminated document and its item.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``.
    """
    mine = _item_windows(items, width)
    sizes = mine.groupBy("item_id", "kind").agg(F.countDistinct("at").alias("item_windows"))
    short = mine.filter(F.col("length") < width).select("kind", "length").distinct().collect()  # fewer than 2 * width

    # A row is known by its id and text: rows equal in both have equal results.
    keyed = docs.select("doc_id", F.col("text").alias("_text")).withColumn("key", F.xxhash64("doc_id", "_text"))
    made = [(TEMPLATE, width), (WORDS, width), *short]
    probe = _probes(keyed, made, width)
    hashes = mine.select("h").distinct()
    met = probe.join(sized(hashes), "h", "left_semi")
    place, end = F.col("pos"), F.lit(0)  # windows of several kinds and widths follow each other: places count from where the own ones begin
    for kind, _ in made[:-1]:
        end = end + F.col("n_words" if kind == WORDS else "n_tokens")
        place = F.when(F.col("pos") >= end, F.col("pos") - end).otherwise(place)
    met = written(met.select("doc_id", "key", place.cast("int").alias("place"), "h").distinct())
    hits = written(met.join(sized(mine), "h").select("doc_id", "key", "place", "item_id", "kind", "length", "at", "values"))

    # Values of the windows with slots.
    asked = hits.filter(F.size("values") > 0).select("key", "place").distinct()
    asked = written(asked)
    source = keyed.join(sized(asked.select("key").distinct()), "key", "left_semi").dropDuplicates(["key"])
    source = source.select("key", template(F.col("_text")).alias("tokens"), slots(F.col("_text")).alias("found"))
    read = asked.join(source, "key").select("key", "place", _values(F.col("tokens"), F.col("found"), F.col("place"), width).alias("found"))
    slotted = hits.filter(F.size("values") > 0).select("key", "item_id", "place", "length", "at", "values").distinct().join(read, ["key", "place"])
    slotted = slotted.withColumn("found", F.slice("found", F.lit(1), F.size("values")))  # an item shorter than a window has fewer
    slotted = written(slotted.withColumn("reach", F.least(F.lit(width), F.col("length"))))
    bare = hits.filter((F.col("kind") == TEMPLATE) & (F.size("values") == 0)).select("key", "item_id", "at")
    free = written(bare.union(slotted.filter("values = found").select("key", "item_id", "at")).distinct())
    slotted = slotted.join(free.withColumn("_free", F.lit(True)), ["key", "item_id", "at"], "left").withColumn("free", F.col("_free").isNotNull())
    counted = free.groupBy("key", "item_id").agg(F.count("*").alias("bare")).join(_agreed(slotted), ["key", "item_id"], "full")
    counted = counted.join(slotted.select("key", "item_id").distinct().withColumn("slotted", F.lit(True)), ["key", "item_id"], "left")
    counted = counted.select(
        "key", "item_id", F.lit(TEMPLATE).alias("kind"), (F.coalesce("bare", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_windows"),
        (F.col("more").isNotNull() | F.col("slotted").isNull()).alias("slots_agree"),
    )
    same = hits.filter(F.col("kind") == WORDS).groupBy("key", "item_id").agg(F.countDistinct("at").alias("n_windows"))
    counted = counted.unionByName(same.select("key", "item_id", F.lit(WORDS).alias("kind"), "n_windows", F.lit(True).alias("slots_agree")))
    out = counted.join(sized(written(sizes)), ["item_id", "kind"]).filter(F.col("n_windows") >= F.least(F.lit(evidence), F.col("item_windows")))
    out = hits.select("doc_id", "key", "item_id").distinct().join(out, ["key", "item_id"])
    best = F.struct((-F.col("kind")).alias("first"), "n_windows", "slots_agree", "item_windows")
    out = out.groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
    return out.select("doc_id", "item_id", "best.n_windows", "best.item_windows", "best.slots_agree")
