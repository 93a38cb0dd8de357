"""Benchmark decontamination by template canonicalisation. DataFrame operations only.

Numbers, names and units become typed placeholders, so that a question with other values has the same template.
Windows of five words, at every word of documents and items, are joined by hash (items of fewer words as a whole); each
hit fixes an alignment of a document with an item, along which words are compared, and the values in the slots must map
one to one. Windows of placeholders alone, of which tables of numbers are full, are no hits: the windows beside them
are. Items that have no other words are sought with their own values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.llm.common import table, written

WINDOW = 5  # words
RUN = 13  # words in a row, or the whole item, that count as a leak
COVER = 0.6  # or this share of an item's words along one alignment
BROADCAST_WINDOWS = 200_000  # up to so many item windows are broadcast (16 bytes each); more are shuffled
# Units that follow a number.
UNITS = "mm cm m km mg g kg t ml l s sec min h hr day days week weeks month months year years mph kmh w kw v a hz khz mhz ghz kb mb gb tb usd eur gbp dollars euros pounds percent meters metres kilometers kilometres miles feet inches grams kilograms liters litres seconds minutes hours degrees"
NAME, NUMBER, UNIT = "\u0001", "\u0002n", "\u0002u"


def marked(text: Column) -> Column:
    """Words of a text, with case, split by one space; names carry NAME in front."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    text = F.translate(text, "\u0001\u0002", "  ")
    has_digit = text.rlike("[0-9]")
    text = F.when(has_digit, F.regexp_replace(F.regexp_replace(text, r"(?<=[0-9])[.,](?=[0-9])", ""), r"(?<=[0-9])(?=\p{L})", " ")).otherwise(text)
    text = F.regexp_replace(text, r"(?<=[\p{Ll}0-9,;:] )(?=\p{Lu}\p{L})", NAME)
    return F.trim(F.regexp_replace(text, "[^\\p{L}\\p{N}\u0001]+", " "))


def plain(words: Column) -> Column:
    return F.lower(F.translate(words, NAME, ""))


def template(words: Column) -> Column:
    """The template of marked words: as many words."""
    low = F.when(F.instr(words, NAME) > 0, F.regexp_replace(words, f"{NAME}\\S+", NAME)).otherwise(words)
    low = F.lower(low)
    numbered = F.regexp_replace(low, r"(?<![^ ])\p{N}+(?![^ ])", NUMBER)
    units = "|".join(UNITS.split())
    return F.when(low.rlike("[0-9]"), F.regexp_replace(numbered, f"(?<={NUMBER} )({units})(?![^ ])", UNIT)).otherwise(low)


def _once(x: DataFrame, **columns: Column) -> DataFrame:
    """x with columns that are evaluated once a row: without the generator, each use would evaluate them again."""
    made = F.struct(*[c.alias(k) for k, c in columns.items()])
    return x.select(*[c for c in x.columns if c not in columns], F.inline(F.array(made)))


def _words(x: DataFrame) -> DataFrame:
    """x with plain and template, the words of text in either form, as strings, and the template with names as they are:
    null where there are none."""
    x = _once(x, w=marked(F.col("text")))
    named = F.when(F.instr("w", NAME) > 0, template(F.translate("w", NAME, "")))
    return _once(x.drop("text"), plain=plain(F.col("w")), template=template(F.col("w")), named=named).drop("w")


def _window(words: str, n: int) -> Column:
    """Hash of the n words at the place at, given the hashes of words; null where the text ends before, and for
    placeholders alone."""
    marks = [F.xxhash64(F.lit(x)) for x in (NAME, NUMBER, UNIT)]
    worded = F.lit(words == "hp")
    for k in range(n):
        worded = worded | ~F.get(F.col(words), F.col("at") + k).isin(marks)
    first = F.get(F.col(words), F.col("at"))
    # the word before decides whether a word is a unit, and it is outside the window
    first = F.when(first.isin([F.xxhash64(F.lit(u)) for u in (*UNITS.split(), UNIT)]), F.xxhash64(F.lit(UNIT))).otherwise(first)
    return F.when((F.col("at") + n <= F.size(words)) & worded, F.xxhash64(first, *[F.get(F.col(words), F.col("at") + k) for k in range(1, n)]))


def _hashes(words: str) -> Column:
    return F.transform(F.split(words, " "), lambda x: F.xxhash64(x))


def _bare(template: Column) -> Column:
    """Whether all words of a template are placeholders."""
    return F.forall(template, lambda w: w.isin(NAME, NUMBER, UNIT))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs(doc_id, text), benchmark(item_id, text) to a row for each document and item it contains:

    doc_id, item_id, n_words (of the item), longest_run, n_matched (both along the best alignment), n_changed (slots with
    another value than the item's). Null and empty texts and null ids have no leaks; repeated rows of a document give one
    row; no rows give no rows; other columns are ignored. An item of fewer words than a window must occur as a whole. One
    that has no other words than numbers, names and units must occur with its own values.
    """
    items = written(_words(benchmark.where("item_id is not null").select("item_id", "text").dropDuplicates()), "items")
    # names may have lost their case, or words won it: windows also match with names taken as words
    at_items = _once(items, ht=_hashes("template"), hn=_hashes("named"), hp=_hashes("plain"), bare=_bare(F.split("template", " ")))
    n_windows, whole, bare = items.select("plain", _bare(F.split("template", " ")).alias("bare"), F.size(F.split("plain", " ")).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.collect_set(F.when((F.col("n") < WINDOW) & (F.col("plain") != "") & ~F.col("bare"), F.col("n"))), F.collect_set(F.when((F.col("plain") != "") & F.col("bare"), F.least("n", F.lit(WINDOW))))
    ).first()  # the lengths of windows: at most four of short items and five of those without words
    at_items = at_items.select("item_id", "ht", "hn", "hp", "bare", F.size("ht").alias("n"), F.posexplode("ht").alias("at", "w"))
    at_items = at_items.select("item_id", F.col("at").alias("at_item"), F.explode(F.array(
        *[_window(c, WINDOW) for c in ("ht", "hn")], *[F.when((F.col("n") == n) & ~F.col("bare"), _window(c, n)) for n in whole for c in ("ht", "hn")], *[F.when((F.least("n", F.lit(WINDOW)) == n) & F.col("bare"), _window("hp", n)) for n in bare]
    )).alias("h")).where("h is not null").distinct()
    if 2 * n_windows <= BROADCAST_WINDOWS:
        at_items = F.broadcast(at_items)
    none = F.lit(None).cast("array<bigint>")
    x = _words(docs.where("doc_id is not null").select("doc_id", "text"))
    x = _once(x, ht=_hashes("template"), hn=_hashes("named"), hp=_hashes("plain") if bare else none).drop("plain", "template", "named")
    x = x.select("doc_id", "ht", "hn", "hp", F.posexplode("ht").alias("at", "w"))
    h = [_window(c, n) for n in (WINDOW, *whole) for c in ("ht", "hn")] + [_window("hp", n) for n in bare]
    x = x.select("doc_id", "at", F.explode(F.array(*h)).alias("h")).where("h is not null")
    found = x.join(at_items, "h").select("doc_id", "item_id", (F.col("at") - F.col("at_item")).alias("shift")).distinct()
    # the shifts of a document along an item are fewer than the words of both; the text is fetched once for all of them
    found = written(found.groupBy("doc_id", "item_id").agg(F.collect_set("shift").alias("shifts")), "leak-hits")

    x = _words(found.join(docs.select("doc_id", "text"), "doc_id")).join(items.select("item_id", F.col("plain").alias("item_plain"), F.col("template").alias("item_template")), "item_id")
    x = _once(x, **{c: F.split(c, " ") for c in ("plain", "template", "item_plain", "item_template")})
    at = "if(s + i < 0, size(plain) + 1, s + i + 1)"
    x = _once(x, along=F.expr(f"transform(shifts, s -> named_struct('s', s, 'm', transform(sequence(0, size(item_plain) - 1), i -> coalesce(try_element_at(plain, {at}) = item_plain[i] or try_element_at(template, {at}) = item_template[i], false))))"))
    run = "aggregate(y.m, named_struct('c', 0, 'b', 0), (s, v) -> named_struct('c', if(v, s.c + 1, 0), 'b', greatest(s.b, if(v, s.c + 1, 0))), s -> s.b)"
    slot = "named_struct('a', concat(item_template[i], item_plain[i]), 'b', concat(item_template[i], plain[y.s + i]))"
    slots = f"array_distinct(transform(filter(sequence(0, size(y.m) - 1), i -> y.m[i] and item_plain[i] <> item_template[i]), i -> {slot}))"
    x = _once(x, along=F.expr(f"transform(along, y -> named_struct('n_matched', size(filter(y.m, v -> v)), 'longest_run', {run}, 'n_words', size(item_plain), 'slots', {slots}))"), own=_bare(F.col("item_template")))
    same = "size(y.slots) = size(array_distinct(y.slots.a)) and size(y.slots) = size(array_distinct(y.slots.b)) and (not own or forall(y.slots, v -> v.a = v.b))"
    leak = f"{same} and (y.longest_run >= least({RUN}, y.n_words) or y.n_matched >= {COVER} * y.n_words)"
    x = x.select("doc_id", "item_id", F.expr(f"array_max(transform(filter(along, y -> {leak}), y -> named_struct('n_matched', y.n_matched, 'longest_run', y.longest_run, 'n_words', y.n_words, 'n_changed', size(filter(y.slots, v -> v.a <> v.b)))))").alias("s")).where("s is not null")
    return x.groupBy("doc_id", "item_id").agg(F.max("s").alias("s")).select("doc_id", "item_id", "s.n_words", "s.longest_run", "s.n_matched", "s.n_changed")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: see leaks()."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
