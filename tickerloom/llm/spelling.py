"""Spelling variants of the corpus's words: near words by asymmetric chunks, forms and roots.

Words are the runs of letters that occur ``min_count`` times or more and have ``min_length`` code
points or more. Two words are near if one inserted, deleted or replaced code point turns one into
the other.

1. Count: runs are folded to (word, n) before the shuffle, so frequent words cost nothing extra.
2. Chunks: the shorter word of a pair (of equal ones, the smaller) contributes two disjoint
   chunks, its halves; the other word its positional grams, of which those can matter that lie
   within shift one of such a chunk. One edit leaves one half whole, so the pair meets on it.
3. A half that many words share is no key yet: where it would make over ``max_pairs`` candidates,
   the part of the word beside it is halved in its turn, and again, down to one code point. Every
   edit lies in exactly one of the parts, so no pair is lost, and it is taken in that part only.
4. Candidates are verified by their edit distance. Near words fold to counts and the best form.
5. A word's form is its near word of largest n, the smallest of them in code-point order, if that
   n is ``ratio`` times its own or more; roots follow the forms by pointer jumping.

Counts grow by ``ratio`` with every form, so roots need few rounds and there are no cycles.

Defined cases: null texts have no words; a null doc_id counts as the empty string where edits are
drawn by doc_id; equal rows count as often as they occur; a run is taken whole however long it is;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import materialize, text_column

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
MAX_PAIRS = 1 << 12
#: One in so many pairs of document and run is misspelled by the query's rule.
ERROR_RATE = 31

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = r"[a-zÀ-ÿ]+"


def with_dropped_letter(run: Column, doc_id: Column, one_in: int = ERROR_RATE) -> Column:
    """The run, less one code point if the crc32 of ``<doc_id>:<run>`` says so."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    code = F.crc32(name.cast("binary"))
    at = (code % F.length(run)).cast("int")
    dropped = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(code % one_in == 0, dropped).otherwise(run)


def count_words(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
    one_in: int | None = None,
) -> DataFrame:
    """(word, n), one row per word. ``one_in`` applies ``with_dropped_letter`` to the runs."""
    runs = F.regexp_extract_all(F.translate(text_column(), _UPPER, _LOWER), F.lit(_RUN), F.lit(0))
    found = docs.select("doc_id", F.explode(runs).alias("run"))
    found = found.filter(F.length("run") >= min_length)  # edits only shorten
    word = F.col("run")
    if one_in is not None:
        word = with_dropped_letter(word, F.col("doc_id"), one_in)
    counted = found.select(word.alias("word")).filter(F.length("word") >= min_length)
    counted = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


# --- chunks ----------------------------------------------------------------------------------------


def _keyed(rows: DataFrame) -> DataFrame:
    """The key of a row: all of the word but the part [low, high) of the shorter one, in which
    the edit is looked for."""
    before = F.substring("word", F.lit(1), F.col("low"))
    after = F.substring("word", F.col("high") + F.col("shift") + 1, F.col("size"))
    return rows.withColumn("key", F.xxhash64("size", "low", "high", before, after))


def _halved(rows: DataFrame) -> DataFrame:
    middle = ((F.col("low") + F.col("high")) / 2).cast("int")
    parts = F.array(
        F.struct(F.col("low").alias("low"), middle.alias("high")),
        F.struct(middle.alias("low"), F.col("high").alias("high")),
    )
    split = rows.withColumn("part", F.explode(parts)).drop("low", "high")
    return _keyed(split.select("*", "part.low", "part.high").drop("part"))


def _chunked(words: DataFrame, min_length: int) -> DataFrame:
    """A row per half: shift 0 of words as the shorter (or equal) one of a pair, with chunks of
    their own, shift 1 of words as the longer one, with grams laid out for a word shorter by one."""
    size = F.length("word")
    roles = F.array(
        F.struct(F.lit(0).alias("shift"), size.alias("size")),
        F.struct(F.lit(1).alias("shift"), (size - 1).alias("size")),
    )
    rows = words.select("word", "n", F.explode(roles).alias("role")).select("word", "n", "role.*")
    rows = rows.filter(F.col("size") >= min_length)
    return _halved(rows.withColumns({"low": F.lit(0), "high": F.col("size")}))


def _measured(rows: DataFrame, max_pairs: int) -> DataFrame:
    """Rows whose key has a pair to offer, and whether its part has to be halved."""
    sizes = rows.groupBy("key").agg(
        F.count_if(F.col("shift") == 0).alias("_short"), F.count(F.lit(1)).alias("_all")
    )
    sizes = sizes.filter("_short > 0 AND _all > 1")
    crowded = F.col("_short") * F.col("_all") > max_pairs
    return rows.join(sizes, "key").select(
        *rows.columns, (crowded & (F.col("high") - F.col("low") > 1)).alias("crowded")
    )


def chunk_rows(words: DataFrame, min_length: int, max_pairs: int) -> DataFrame:
    """The rows that pairs are taken from; crowded keys are halved until none is left."""
    ready = None
    level = _chunked(words, min_length)
    while True:
        measured = materialize(_measured(level, max_pairs), "chunks")
        settled = measured.filter(~F.col("crowded"))
        ready = settled if ready is None else ready.unionByName(settled)
        if not measured.filter("crowded").limit(1).count():
            return ready
        level = _halved(measured.filter("crowded").drop("crowded", "key"))


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """(word, n, other, other_n): every two near words once, ``word`` the shorter or smaller."""
    rows = chunk_rows(words, min_length, max_pairs)
    short = rows.filter("shift = 0").select("key", "size", "high", "word", "n")
    other = rows.select("key", "shift", F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = short.join(other, "key").filter((F.col("shift") == 1) | (F.col("word") < F.col("other")))
    # The first difference lies in the part, or else the pair is taken in a later one.
    same = F.substring("word", F.lit(1), F.col("high")) == F.substring("other", F.lit(1), F.col("high"))
    inside = (F.col("high") == F.col("size")) | ~same
    near = F.levenshtein("word", "other", 1) == 1
    return pairs.filter(inside & near).select("word", "n", "other", "other_n")


# --- forms and roots ---------------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        above = roots.select(F.col("word").alias("root"), F.col("root").alias("_above"))
        jumped = roots.join(above, "root", "left").select(
            "word", F.coalesce("_above", "root").alias("root"),
            F.col("_above").isNotNull().alias("_moved"),
        )
        jumped = materialize(jumped, "roots")
        if not jumped.filter("_moved").limit(1).count():
            return jumped.drop("_moved")
        roots = jumped.drop("_moved")


def group_variants(
    words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO, max_pairs: int = MAX_PAIRS
) -> DataFrame:
    """(word, n, n_near, form, form_n, root), one row per word of ``words`` (word, n)."""
    words = materialize(words, "words")
    pairs = near_words(words, min_length, max_pairs)
    ends = F.array(
        F.struct(F.col("word"), F.col("n"), F.col("other"), F.col("other_n")),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"),
                 F.col("word").alias("other"), F.col("n").alias("other_n")),
    )
    directed = pairs.select(F.inline(ends))
    better = F.col("other_n") >= F.col("n") * ratio
    best = F.min(F.when(better, F.struct((-F.col("other_n")).alias("minus"), F.col("other"))))
    found = directed.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = materialize(
        found.select("word", "n_near", F.col("best.other").alias("form"),
                     (-F.col("best.minus")).alias("form_n")), "near",
    )
    roots = _roots(found.filter("form IS NOT NULL"))
    return (
        words.join(found, "word", "left").join(roots, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
        )
    )
