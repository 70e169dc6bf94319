"""Keyword safety over a table of words of any length, by joins.

Each word has an anchor: of its runs of ``GRAM`` characters (all of it, if it is shorter) the
one that the fewest words of the lexicon hold.  Texts meet words by equal anchors, each text
by its distinct runs, and a word counts where the text contains it.  Every containing text
holds the word's anchor, so nothing is missed; rare anchors keep the candidates few.

Nothing is collected, and nothing is sent to all tasks but what Spark's planner finds small.
Each distinct text is searched once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batch import scattered_key
from .stage import Stage, add_verdict
from .validators import keyword_verdict

GRAM = 6
# Longer texts are cut, with overlaps, so that no row holds the runs of a very long one.
SEGMENT = 1 << 16


def _runs(text: Column, size: int) -> Column:
    """All different runs of ``size`` characters, in one pass."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def _segments(text: Column) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(SEGMENT))
    return F.transform(starts, lambda at: F.substring(text, at, F.lit(SEGMENT + GRAM)))


class Lexicon(Stage):
    """``keyword_safety`` over a table of (category, keyword), however long.

    Categories come in sort order.  Keywords are compared in lower case; null and empty ones,
    and null categories, are left out.  For batch tables; on a stream, use it in foreachBatch.
    """

    def __init__(self, lexicon: DataFrame, category: str = "category", keyword: str = "keyword",
                 name: str = "ContentSafety"):
        super().__init__(name)
        self.words = lexicon.select(
            F.col(category).alias("category"), F.lower(F.col(keyword)).alias("word"),
        ).where("category is not null and word <> ''").distinct()

    def anchors(self) -> DataFrame:
        """(gram, word): each word under its rarest run of characters."""
        words = self.words.select("word").distinct()
        size = F.least(F.length("word"), F.lit(GRAM))
        runs = F.lit(None).cast("array<string>")
        for n in range(1, GRAM + 1):
            runs = F.when(size == n, _runs(F.col("word"), n)).otherwise(runs)
        grams = words.select("word", F.explode(runs).alias("gram"))
        common = grams.groupBy("gram").agg(F.count("*").alias("n"))
        return grams.join(common, "gram").groupBy("word").agg(
            F.min(F.struct("n", "gram")).alias("least")).select("least.gram", "word")

    def sizes(self) -> list[int]:
        """Lengths of anchors; one row each, ``GRAM`` at most."""
        size = F.least(F.length("word"), F.lit(GRAM)).alias("size")
        return sorted(r["size"] for r in self.words.select(size).distinct().collect())

    def found(self, texts: DataFrame) -> DataFrame:
        """(key, categories) of the texts (key, text) that hold a word."""
        sizes = self.sizes() or [GRAM]
        parts = texts.select("key", F.explode(_segments(F.col("text"))).alias("part"))
        grams = parts.select("key", F.explode(
            F.concat(*[_runs(F.col("part"), n) for n in sizes])).alias("gram"))
        candidates = grams.join(self.anchors(), "gram").select("key", "word").distinct()
        holding = candidates.join(texts, "key").where(F.contains("text", "word")).select("key", "word")
        return holding.join(self.words, "word").groupBy("key").agg(
            F.array_sort(F.collect_set("category")).alias("categories"))

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        lower, key, hits, on = (f"__{self.name}_{x}" for x in ("lower", "key", "hits", "on"))
        df = df.withColumn(on, F.lit(True) if active is None else F.coalesce(active, F.lit(False)))
        df = df.withColumn(lower, F.when(F.col(on) & (F.col(text_col) != ""), F.lower(F.col(text_col))))
        digest = F.sha2(F.col(lower), 256)
        texts = df.select(F.col(lower).alias("text")).where("text is not null").distinct().select(
            F.sha2("text", 256).alias("key"), "text")
        found = self.found(texts).toDF(key, hits)
        df = df.withColumn(key, scattered_key(df, digest)).join(found, key, "left").drop(key, lower)
        violations = F.coalesce(F.col(hits), F.array().cast("array<string>"))
        return add_verdict(df, self.name, text_col, F.col(on), keyword_verdict(violations)).drop(hits, on)


def keyword_lexicon(
    lexicon: DataFrame, category: str = "category", keyword: str = "keyword",
    name: str = "ContentSafety",
) -> Stage:
    """A ``Lexicon`` stage."""
    return Lexicon(lexicon, category, keyword, name)
