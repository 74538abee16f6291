"""Search of many queries in many names by word similarity, over an inverted index of trigrams.

A name can only reach the threshold for a query if it holds more than that share of
the query's distinct trigrams.  With ``n`` trigrams, of which more than ``t n`` must be
shared, each match holds one of any ``n - floor(t n)`` of them; the rarest ones are
taken, by the index's own counts, so that a query meets the names of its rare trigrams
and not every name.  What is found is scored exactly.

The index is a table of (gram, id), ordered by gram: a search for a few queries pushes
their rarest trigrams down to the files, which skip all others; with many queries the
same trigrams are joined.  A trigram that very many names hold is only looked up when
all of a query's rarest ones are that common; such rows are dealt over ``SALTS``.

Defined cases: names and queries that are null or have no letter or digit match
nothing; repeated names and queries are found each on their own; ids are unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from leaguespark.functions import similarity

#: Trigrams that are pushed down as a list; more of them are joined.
PUSHED = 2_000
#: Postings of one trigram from which its rows are salted, and the salts.
COMMON = 1_000_000
SALTS = 32


def postings(names: DataFrame, id_column: str = "id", name: str = "nom") -> DataFrame:
    """(gram, id): each distinct trigram of each name."""
    return names.select(F.explode(F.array_distinct(similarity.trigrams(F.col(name)))).alias("gram"), F.col(id_column).alias("id"))


class TrigramIndex:
    """Postings and counts as tables in a folder."""

    def __init__(self, names: DataFrame, path: str, id_column: str = "id", name: str = "nom", build: bool = True) -> None:
        self.spark, self.path, self.names, self.id, self.name = names.sparkSession, path.rstrip("/"), names, id_column, name
        if build:
            found = postings(names, id_column, name)
            # The id takes part in the ranges, so that a trigram of very many names is several files.
            found.repartitionByRange("gram", "id").sortWithinPartitions("gram", "id").write.mode("overwrite").parquet(f"{self.path}/postings")
            self._read("postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.path}/counts")

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}")

    def prefixes(self, queries: DataFrame, threshold: float = similarity.THRESHOLD) -> DataFrame:
        """(qid, gram, n): the rarest trigrams of each query (qid, q), one of which every match holds; n names hold them."""
        grams = queries.select("qid", F.explode(F.array_distinct(similarity.trigrams(F.col("q")))).alias("gram"))
        sized = grams.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("qid")))
        counted = sized.join(self._read("counts"), "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        rank = F.row_number().over(Window.partitionBy("qid").orderBy("n", "gram"))
        return counted.withColumn("rank", rank).filter(F.col("rank") <= F.col("size") - F.floor(F.col("size") * threshold + 1e-9)).filter("n > 0").select("qid", "gram", "n")

    def candidates(self, queries: DataFrame, threshold: float = similarity.THRESHOLD) -> DataFrame:
        """(qid, id) that share one of the query's rarest trigrams, each once."""
        wanted, held = self.prefixes(queries, threshold), self._read("postings")
        few = [r.gram for r in wanted.select("gram").distinct().limit(PUSHED + 1).collect()]  # at most that many texts of three letters
        if len(few) <= PUSHED:
            held = held.filter(F.col("gram").isin(few))
        own = wanted.withColumn("salts", F.when(F.col("n") > COMMON, F.lit(SALTS)).otherwise(F.lit(1)))
        own = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        common = self._read("counts").filter(F.col("n") > COMMON).select(F.col("gram").alias("c_gram"))
        dealt = held.join(common, F.col("gram") == F.col("c_gram"), "left").withColumn("p_salt", F.when(F.col("c_gram").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
        met = own.join(dealt.withColumnRenamed("gram", "p_gram").drop("c_gram"), (F.col("gram") == F.col("p_gram")) & (F.col("salt") == F.col("p_salt")))
        return met.select("qid", "id").distinct()

    def search(self, queries: DataFrame, threshold: float = similarity.THRESHOLD) -> DataFrame:
        """(qid, id, nom, score) of names above the threshold; queries: qid, q."""
        found = self.candidates(queries, threshold).join(queries.select("qid", "q"), "qid")
        named = found.join(self.names.select(F.col(self.id).alias("id"), F.col(self.name).alias("nom")), "id")
        # Equal texts are compared once.  All conditions are on an aggregate's result, so none moves below the grouping or to another side of the join.
        texts = named.groupBy("q", "nom").agg(F.max("nom").alias("text")).filter(similarity.may_match(F.col("q"), F.col("text"), threshold))
        scored = texts.withColumn("score", similarity.word_similarity(F.col("q"), F.col("text"))).filter(F.col("score") > threshold)
        return named.join(scored, ["q", "nom"]).select("qid", "id", "nom", "score")

    def best(self, queries: DataFrame, limit: int, threshold: float = similarity.THRESHOLD) -> DataFrame:
        """The best ``limit`` names of each query, ties by id."""
        rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "id"))
        return self.search(queries, threshold).withColumn("rank", rank).filter(F.col("rank") <= limit)
