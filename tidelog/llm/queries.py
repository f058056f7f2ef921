"""Queries p6 to p8: leaked test items, mixtures of sources, garbled text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import leaks, mixing, mojibake
from tidelog.session import table


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also passages that aren't word for word: all windows at least 0.8 similar."""
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), exact=False)


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mixture(mixing.token_counts(table(spark, sf_dir, "documents")), table(spark, sf_dir, "mix_targets"))


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[1]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.garbled(table(spark, sf_dir, "documents")).select("doc_id")


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.garbled(table(spark, sf_dir, "documents"))


#: Documents from which p7_checks takes the median one as measure.
MANY = 50


def p7_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per listed source what must hold of any mixture: documents and caps, and whether its tokens are as near to their
    share as one median document of it. Of fewer than MANY documents one may outweigh all that the others can give or
    take, so there its longest document is the measure, which holds for any source."""
    sizes = mixing.token_counts(table(spark, sf_dir, "documents"))
    _, report = mixing.mixture(sizes, table(spark, sf_dir, "mix_targets"))
    aim = F.col("mean_copies") * F.col("available")
    median = sizes.where("tokens > 0").groupBy("source").agg(
        F.percentile_approx("tokens", 0.5, 1000).alias("median"), F.max("tokens").alias("longest"), F.count(F.lit(1)).alias("n")
    )
    near = F.abs(F.col("tokens") - aim) <= F.coalesce(F.when(F.col("n") < MANY, F.col("longest")).otherwise(F.col("median")), F.lit(0))
    return report.join(median, "source", "left").select(
        "source", "max_repeats", "documents", (F.coalesce("most_copies", F.lit(0)) <= F.col("max_repeats")).alias("cap_kept"), near.alias("share_met")
    )


QUERIES = {f.__name__: f for f in (p6_found, p6_near, p7_mixture, p7_shares, p7_checks, p8_found, p8_restored)}

#: Texts can't be re-decoded nor mixtures drawn alike in SQL; p6 and what must hold of any mixture can be told.
_WORDS = """
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(item_text), '[a-z0-9]+') AS w FROM eval_items),"""
_SOURCE = "regexp_replace(trim(lower(source)), '[-_ ]', '_', 'g')"

ORACLE = {
    "p6_found": rf"""
WITH {_WORDS}
dw AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 24], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 23)) AS k FROM d WHERE len(w) > 24)),
iw AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 24], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 23)) AS k FROM i WHERE len(w) > 24))
SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (s)""",
    # A shingle and how often it stood in the window before: pairs equal in both are as many as the windows share.
    "p6_near": rf"""
WITH {_WORDS}
ish AS (SELECT item_id, k, array_to_string(w[k:k + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS k FROM i WHERE len(w) > 24)),
dsh AS (SELECT doc_id, k, s FROM (SELECT doc_id, k, array_to_string(w[k:k + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d WHERE len(w) > 24)) SEMI JOIN ish USING (s)),
ilen AS (SELECT item_id, len(w) AS n FROM i), dlen AS (SELECT doc_id, len(w) AS n FROM d),
iwin AS (SELECT item_id, pos, s, row_number() OVER (PARTITION BY item_id, pos, s ORDER BY k) AS nth
    FROM (SELECT item_id, k, s, unnest(range(greatest(1, k - 20), least(k, n - 24) + 1)) AS pos FROM ish JOIN ilen USING (item_id))),
dall AS (SELECT doc_id, k, s, unnest(range(greatest(1, k - 20), least(k, n - 24) + 1)) AS pos FROM dsh JOIN dlen USING (doc_id)),
dwin AS (SELECT doc_id, pos, s, row_number() OVER (PARTITION BY doc_id, pos, s ORDER BY k) AS nth FROM dall QUALIFY count(*) OVER (PARTITION BY doc_id, pos) >= 19),
shared AS (SELECT doc_id, dwin.pos AS a, item_id, iwin.pos AS b, count(*) AS n FROM dwin JOIN iwin USING (s, nth) GROUP BY ALL HAVING count(*) >= 19)
SELECT doc_id, item_id, max(n / (42.0 - n)) AS similarity FROM shared GROUP BY ALL HAVING max(n / (42.0 - n)) >= 0.8""",
    "p7_checks": f"""
WITH t AS (SELECT {_SOURCE} AS source, max(max_repeats) AS max_repeats FROM mix_targets GROUP BY 1),
d AS (SELECT {_SOURCE} AS source, count(*) AS documents FROM documents GROUP BY 1)
SELECT t.source, max_repeats, coalesce(documents, 0) AS documents, TRUE AS cap_kept, TRUE AS share_met FROM t LEFT JOIN d USING (source)""",
}
