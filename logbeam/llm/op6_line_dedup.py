"""Operator 6: line dedup by a deletion-neighbourhood join.

All DataFrame functions.  A line is its sequence of words; two lines are the
same when their words are, and near when one word inserted, deleted or
replaced turns one into the other (``EDITS`` = 1, for lines of ``MIN_WORDS``
words or more; shorter ones must be the same).  Each line emits its variants
within the bound, the line itself and the line without each of its words, as
hashed keys; equal variants are joined, the word edit distance of the pair is
verified, and of every such pair the line that stands first, by doc_id and
place in the document, stays.

Two savings leave the result as it is: same lines are settled first, so only
distinct lines emit variants; and by the pigeonhole principle near lines
share their first or second half, so distinct lines whose halves stand alone
in the corpus emit none.  Variants are formed from running sums of position
hashes, so a line of any length costs one row a word.  Keys are counted first
and only rows whose key occurs again go on (``keyfilter.py``); every group is
reduced to its first line before it is joined, so a hot line or variant never
expands into pairs.

Edge cases: blank lines and null or empty texts are never touched; rows with
a null doc_id are neither compared nor changed; rows that repeat a doc_id
share the fate of their lines; of equal or near lines the one with the least
doc_id, then place, stays; very long texts and lines are worked on whole; an
empty table gives an empty one; a document whose last line goes is dropped by
``dedup_lines`` and reported with nothing kept by ``line_report``; other
columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import few, scratch_name, written
from .keyfilter import may_hold

SPACE = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
EDITS = 1
MIN_WORDS = 10
KEY = ["h1", "h2"]
LINE = ["doc_id", "pos", "h1"]
#: Removed lines that are broadcast at most (some 40 MB); more are joined by shuffle.
FEW_LINES = 2_000_000


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line) per line, without white space at the ends."""
    lines = docs.where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.withColumn("line", F.btrim("line", F.lit(SPACE)))


def _words(lines: DataFrame) -> DataFrame:
    """(doc_id, pos, words) per line with words."""
    # through a generator, so the words are cut once and not in every use
    return lines.where("line != ''").select("doc_id", "pos", F.inline(F.array(F.struct(F.split("line", GAP).alias("words")))))


def _half_keys(words: Column, n: Column) -> Column:
    """Keys of the halves by which a line meets a near line, as the shorter
    (or equally long) line of the pair and as the longer one; null for lines
    too short to be near any."""

    def keys(short: Column) -> list[Column]:
        first = F.floor(short / 2).cast("int")
        rest = short - first
        return [
            F.xxhash64(F.lit("first"), short, F.slice(words, F.lit(1), first)),
            F.xxhash64(F.lit("last"), short, F.slice(words, n - rest + 1, rest)),
        ]

    shorter, longer = keys(n), keys(n - 1)
    return F.when(n > MIN_WORDS, F.array(*shorter, *longer)).when(n == MIN_WORDS, F.array(*shorter))


def line_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, h1, h2, halves): a 128-bit key of each line's words and
    its half keys (null for short lines)."""
    halves = _half_keys(F.col("words"), F.size("words"))
    return _words(_lines(docs)).select(
        "doc_id", "pos", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(6), "words").alias("h2"), halves.alias("halves"))


def _again(rows: DataFrame, key: list[str], filtered: Column) -> DataFrame:
    """The rows whose ``key`` occurs more than once; ``filtered`` is a 64-bit
    part of the key."""
    many = written(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(*key), "repeated-keys")
    part = many.select(filtered.alias("part"))
    return may_hold(rows, filtered, part).join(many, key, "left_semi")


def _same(keys: DataFrame) -> DataFrame:
    """(doc_id, pos) of the lines that are the same as an earlier one."""
    rows = _again(keys.select("doc_id", "pos", *KEY), KEY, F.col("h1"))
    rows = written(rows, "same-lines")
    firsts = rows.groupBy(*KEY).agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    later = rows.join(firsts, KEY).where("doc_id != first.doc_id or pos != first.pos")
    return written(later.select("doc_id", "pos").distinct(), "later-lines")


def _near_candidates(distinct: DataFrame) -> DataFrame:
    """Distinct lines that share a half with another: (doc_id, pos, h1)."""
    halves = distinct.where("halves is not null").select("doc_id", "pos", "h1", F.explode("halves").alias("half"))
    return written(_again(halves, ["half"], F.col("half")).select("doc_id", "pos", "h1").distinct(), "near-candidates")


def _variants(lines: DataFrame) -> DataFrame:
    """(doc_id, pos, h1, gap, rest, whole): one row for each word that goes,
    with the key of what is left by length (``rest``) and also by the gap's
    place (``gap``), and a row with ``whole`` for the line itself.

    A key is made of the sums over the words of two hashes of word and place;
    without a word the later ones stand one place earlier.
    """
    words = lines.select(*LINE, F.size("words").alias("n"), F.posexplode("words").alias("i", "w"))

    def h(salt: int, place: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.lit(salt), "w", place.cast("int")), 24)

    line = W.partitionBy(*LINE)
    upto = line.orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    out = words
    for s in (1, 2):
        out = out.withColumn(f"here{s}", h(s, F.col("i"))).withColumn(f"back{s}", h(s, F.col("i") - 1))
    sums = [F.sum(f"here{s}").over(upto).alias(f"upto{s}") for s in (1, 2)]
    sums += [F.sum(f"back{s}").over(upto).alias(f"past{s}") for s in (1, 2)]
    sums += [F.sum(f"{c}{s}").over(line).alias(f"all_{c}{s}") for c in ("here", "back") for s in (1, 2)]
    out = out.select("*", *sums)
    left = [F.col(f"upto{s}") - F.col(f"here{s}") + F.col(f"all_back{s}") - F.col(f"past{s}") for s in (1, 2)]
    key = F.xxhash64(F.col("n") - 1, *left)
    one_gone = F.struct(F.xxhash64(key, "i").alias("gap"), key.alias("rest"), F.lit(False).alias("whole"))
    itself = F.xxhash64("n", "all_here1", "all_here2")
    all_of_it = F.struct(itself.alias("gap"), itself.alias("rest"), F.lit(True).alias("whole"))
    return out.select(*LINE, F.inline(F.when(F.col("i") == 0, F.array(one_gone, all_of_it)).otherwise(F.array(one_gone))))


def one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one inserted, deleted or replaced
    word apart."""

    def grown(short: Column, long: Column) -> Column:
        p = F.array_position(F.zip_with(short, long, lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int")
        return F.slice(short, F.greatest(p, F.lit(1)), F.size(short)) == F.slice(long, p + 1, F.size(long))

    p = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int")
    replaced = (p == 0) | (F.slice(a, p + 1, F.size(a)) == F.slice(b, p + 1, F.size(b)))
    return (
        F.when(F.size(a) == F.size(b), replaced)
        .when(F.size(b) == F.size(a) + 1, grown(a, b))
        .when(F.size(a) == F.size(b) + 1, grown(b, a))
        .otherwise(False)
    )


def _near(candidates: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, pos, h1) of the distinct lines with a near line before them."""
    ident = F.xxhash64("doc_id", "pos")
    texts = _words(may_hold(_lines(docs), ident, candidates.select(ident.alias("id"))))
    texts = texts.withColumn("h1", F.xxhash64("words")).join(candidates, LINE, "left_semi").dropDuplicates(LINE)
    texts = written(texts, "candidate-lines")
    variants = written(_variants(texts), "variants")
    line = F.struct(*LINE)

    # replaced words: the same rest by the same gap
    shared = written(_again(variants.where("not whole").select(*LINE, "gap"), ["gap"], F.col("gap")), "shared-gaps")
    first = shared.groupBy("gap").agg(F.min(line).alias("early"))
    links = shared.join(first, "gap").select(line.alias("line"), "early")
    # inserted words: a line equal to another's rest, each way
    whole = variants.where("whole").select("rest", line.alias("long"))
    shorter = may_hold(variants.where("not whole").select(*LINE, "rest"), F.col("rest"), whole.select("rest"))
    inserted = written(shorter.select("rest", line.alias("short")).join(whole.withColumnRenamed("long", "whole"), "rest"), "insertions")
    links = links.union(inserted.select(F.col("short").alias("line"), F.col("whole").alias("early")))
    links = links.union(
        inserted.groupBy("whole").agg(F.min("short").alias("early")).select(F.col("whole").alias("line"), "early"))
    links = links.where("early.doc_id < line.doc_id or (early.doc_id = line.doc_id and early.pos < line.pos)").distinct()

    words = texts.select(line.alias("line"), "words")
    compared = (
        links.join(words, "line")
        .join(words.select(F.col("line").alias("early"), F.col("words").alias("early_words")), "early")
    )
    return compared.where(one_edit(F.col("words"), F.col("early_words"))).select("line.*").distinct()


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos) of every line that goes: it is the same as, or near, a
    line that stands before it."""
    keys = written(line_keys(docs), "line-keys")
    same = _same(keys)
    later = F.broadcast(same) if few(same, FEW_LINES) else same
    distinct = keys.join(later, ["doc_id", "pos"], "left_anti")
    near = _near(_near_candidates(distinct), docs).select("doc_id", "pos")
    return same.union(near).distinct()


def _with_kept(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with the array of kept lines (null text: null) and the number
    of removed ones, under unused names."""
    gone_name = scratch_name("gone_lines", docs.columns)
    id_name = scratch_name("gone_doc_id", docs.columns)
    lines_name = scratch_name("all_lines", docs.columns)
    kept_name = scratch_name("kept_lines", docs.columns)
    removed = written(repeated_lines(docs.select("doc_id", "text")), "removed-lines")
    per_doc = removed.groupBy(F.col("doc_id").alias(id_name)).agg(F.collect_set("pos").alias(gone_name))
    if few(removed, FEW_LINES):
        per_doc = F.broadcast(per_doc)
    joined = docs.join(per_doc, F.col("doc_id") == F.col(id_name), "left").drop(id_name)
    cut = joined.select(*docs.columns, gone_name, F.inline(F.array(F.struct(F.split("text", "\n").alias(lines_name)))))
    places = F.array_except(F.sequence(F.lit(0), F.size(lines_name) - 1), F.col(gone_name))
    some = F.transform(places, lambda i: F.get(F.col(lines_name), i))
    kept = F.when(F.col(gone_name).isNull() | F.col(lines_name).isNull(), F.col(lines_name)).otherwise(some)
    out = cut.withColumn(kept_name, kept).withColumn(gone_name, F.coalesce(F.size(gone_name), F.lit(0)))
    return out.drop(lines_name), kept_name, gone_name


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, text): each document with the text that
    stays."""
    out, kept, gone = _with_kept(docs.select("doc_id", "text"))
    return out.select(
        "doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"), F.col(gone).alias("n_removed"),
        F.array_join(kept, "\n").alias("text"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` (``n_chars``
    follows where it is a column); documents left without a word go."""
    out, kept, gone = _with_kept(docs)
    text = F.array_join(kept, "\n")
    touched = F.col(gone) > 0
    out = out.where(~touched | text.rlike(r"[^\x20\x09-\x0D]"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.when(touched, text).otherwise(F.col(c)).alias(c))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            columns.append(F.when(touched, F.char_length(text).cast(kind)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return out.select(*columns)
