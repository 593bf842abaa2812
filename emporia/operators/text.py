"""Text operators: keyword table function and comment moderation.

The keyword function is a column expression (``explode(split(...))``),
so it runs inside whole-stage codegen; a Python ``@udtf`` twin is
registered for SQL ``LATERAL`` use. Word-list screening runs all listed
words at once as an automaton over the Arrow text buffers, one look-up per
byte of text. A list above ``MOST_LIST_BYTES`` is not sent to the tasks:
then the words' first letters are joined with the distinct short strings
of each record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.functions.scalars import last_token
from emporia.operators.automaton import Automaton
from emporia.session import bounded_batches, ship_code

# Token pattern of the keyword function (letters and digits
# of any script), and of word lists (letters of any script).
KEYWORD_SPLIT = r"[^\p{L}\p{N}]+"
WORD_SPLIT = r"[^\p{L}]+"
SEED = 3  # letters that propose a word of a long list
# A list up to MOST_LIST_BYTES is sent to the tasks, as automata of about BLOCK_BYTES of words each (a state
# per byte at most, four bytes per state and letter).
MOST_LIST_BYTES, BLOCK_BYTES = 1 << 18, 1 << 16
STEP_BYTES = 1 << 20  # text that one step of the automata reads


def tokens(text: Column, pattern: str = KEYWORD_SPLIT) -> Column:
    """Lower-cased tokens of a text, empty tokens removed (array column)."""
    return F.filter(F.split(F.lower(text), pattern), lambda t: t != "")


def explode_tokens(df: DataFrame, col: str, alias: str = "keyword", pattern: str = KEYWORD_SPLIT) -> DataFrame:
    """One row per token of ``col`` (the table function joined laterally)."""
    return df.withColumn(alias, F.explode(tokens(F.col(col), pattern))).drop(col)


def register_keyword_udtf(spark) -> None:
    """T1 (SQL form): ``SELECT ... FROM t, LATERAL ik_analyze(text)``."""
    import re

    from pyspark.sql.functions import udtf

    splitter = re.compile(r"[\W_]+")  # all but letters and numbers of any script

    @udtf(returnType="keyword: string")
    class KeywordUDTF:
        def eval(self, text: str):
            if text is None:
                return
            for tok in splitter.split(text.lower()):
                if tok:
                    yield (tok,)

    spark.udtf.register("ik_analyze", KeywordUDTF)


def running_sets(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """A8 state: per key the record count and, per column, the sorted
    distinct values joined by commas (partial aggregates: ``collect_set``
    combines map-side)."""
    aggs = [F.count(F.lit(1)).alias("pv")]
    aggs += [F.array_join(F.array_sort(F.collect_set(c)), ",").alias(c) for c in cols]
    return df.groupBy(key).agg(*aggs)


# ------------------------------------------------------------------ T2-T5

def check_last_word(df: DataFrame, words: DataFrame, text: str = "msg", id_col: str = "id") -> DataFrame:
    """The last comma token (trailing commas stripped, blanks trimmed) is a
    listed word -> ``is_violation`` 1, grade ``P0``, message = that word."""
    tok = F.regexp_replace(last_token(F.col(text), ","), r"^\s+|\s+$", "")
    w = words.select(F.col("word").alias("_w")).distinct()
    x = df.withColumn("_last", tok).join(w, F.col("_last") == F.col("_w"), "left")
    hit = F.col("_w").isNotNull()
    return (x.withColumn("is_violation", hit.cast("int"))
            .withColumn("violation_grade", F.when(hit, F.lit("P0")).otherwise(F.lit("")))
            .withColumn("violation_msg", F.when(hit, F.col("_w")).otherwise(F.lit("")))
            .drop("_last", "_w"))


def _seeds_of(letters: str) -> Column:
    """The distinct strings of one to ``SEED`` letters in a column of letters."""
    def runs(n: int) -> Column:
        at = F.sequence(F.lit(0), F.size(letters) - n)
        return F.when(F.size(letters) >= n, F.transform(at, lambda i: F.concat(
            *[F.get(F.col(letters), i + k) for k in range(n)]))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[runs(n) for n in range(1, SEED + 1)]))


def _listed(words: DataFrame) -> list[bytes] | None:
    """The distinct words in byte order, or None when they take more than ``MOST_LIST_BYTES``."""
    w = words.select(F.col("word").alias("w")).where(F.col("w") != "").distinct()
    if (w.agg(F.sum(F.octet_length("w"))).first()[0] or 0) > MOST_LIST_BYTES:
        return None
    return sorted(r.w.encode() for r in w.collect())


def _automata(words: list[bytes]) -> list[tuple[int, Automaton]]:
    """(place of its first word, automaton) of every block of the list."""
    ends = np.cumsum([len(w) for w in words])
    block = (ends - 1) // BLOCK_BYTES
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])).tolist()
    return [(a, Automaton(words[a:z])) for a, z in zip(starts, [*starts[1:], len(words)])]


def _with_found(df: DataFrame, words: list[bytes], text: Column, out: str) -> DataFrame:
    """``df`` and a column of the listed words in ``text``, sorted and joined by ``", "``; null when there is none."""
    spark = df.sparkSession
    ship_code(spark)
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast((_automata(words), [w.decode() for w in words]))
    read = df.withColumn(out, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, names = sent.value
        for batch in batches:
            col = batch.column(batch.num_columns - 1).cast(pa.large_string()).fill_null("")
            _, offsets, data = col.buffers()
            offs = np.frombuffer(offsets, np.int64, len(col) + 1, col.offset * 8)
            buf = np.frombuffer(data, np.uint8) if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
            found: list[str | None] = []
            i = 0
            while i < len(col):
                j = max(i + 1, int(np.searchsorted(offs, offs[i] + STEP_BYTES, "right")) - 1)
                hits = [a.rows(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]) for _, a in blocks]
                row = np.concatenate([r for r, _ in hits])
                word = np.concatenate([w + first for (first, _), (_, w) in zip(blocks, hits)])
                word = word[np.argsort(row, kind="stable")].tolist()  # blocks are in byte order, so each row's words are
                ends = np.cumsum(np.bincount(row, minlength=j - i)).tolist()
                found += [", ".join([names[w] for w in word[a:z]]) if z > a else None for a, z in zip([0, *ends], ends)]
                i = j
            yield batch.set_column(batch.num_columns - 1, out, pa.array(found, pa.string()))

    return read.mapInArrow(run, read.schema)


def find_words(df: DataFrame, words: DataFrame, text: str = "msg", id_col: str = "id") -> DataFrame:
    """Distinct listed words contained anywhere in each record's lower-cased
    text, in any script and inside longer words too: ``id_col, found``
    (sorted, joined by ``", "``); records without any are absent."""
    listed = _listed(words)
    if listed is None:
        return find_words_by_join(df, words, text, id_col)
    rows = df.select(id_col, F.lower(F.col(text)).alias("_text"))
    return _with_found(rows, listed, F.col("_text"), "found").drop("_text").where("found is not null")


def find_words_by_join(df: DataFrame, words: DataFrame, text: str = "msg", id_col: str = "id") -> DataFrame:
    """:func:`find_words` for lists too long to be sent to every task.

    A word is proposed by its first ``SEED`` letters (equi-join with the
    text's distinct strings of that length) and then looked for in the
    text; the words proposed for a record are at most the list.
    """
    low = df.select(id_col, F.lower(F.col(text)).alias("_text"))
    letters = low.select(id_col, F.filter(F.split("_text", ""), lambda c: c != "").alias("_letters"))
    seeds = letters.select(id_col, F.explode(_seeds_of("_letters")).alias("_seed"))
    w = words.select(F.col("word").alias("_w")).where(F.col("_w") != "").distinct()
    w = w.withColumn("_seed", F.substring("_w", 1, SEED))
    proposed = seeds.join(w, "_seed").groupBy(id_col).agg(F.collect_set("_w").alias("_ws"))
    found = low.join(proposed, id_col).select(
        id_col, F.filter("_ws", lambda x: F.contains(F.col("_text"), x)).alias("_f"))
    return found.where(F.size("_f") > 0).select(id_col, F.array_join(F.array_sort("_f"), ", ").alias("found"))


def check_all_words(df: DataFrame, words: DataFrame, text: str = "msg", id_col: str = "id") -> DataFrame:
    """Records still clean after T2 are screened for every listed word
    in the text -> ``is_violation`` 1, grade ``P1``, message = the words."""
    clean = F.col("is_violation") == 0
    listed = _listed(words)
    if listed is None:
        x = df.join(find_words_by_join(df.where(clean), words, text, id_col), id_col, "left")
    else:
        x = _with_found(df, listed, F.when(clean, F.lower(F.col(text))), "found")
    hit = (F.col("is_violation") == 0) & F.col("found").isNotNull()
    return (x.withColumn("violation_grade", F.when(hit, F.lit("P1")).otherwise(F.col("violation_grade")))
            .withColumn("violation_msg", F.when(hit, F.col("found")).otherwise(F.col("violation_msg")))
            .withColumn("is_violation", F.when(hit, F.lit(1)).otherwise(F.col("is_violation")))
            .drop("found"))


def membership(candidates: DataFrame, words: DataFrame, col: str = "word") -> DataFrame:
    """T5: for each candidate word, whether it is in the list."""
    w = words.select(F.col("word").alias("_w")).distinct()
    x = candidates.join(w, F.col(col) == F.col("_w"), "left")
    return x.withColumn("is_member", F.col("_w").isNotNull()).drop("_w")
