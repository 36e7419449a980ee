"""Decisions of a model's life: promotion, retraining, splits and baselines."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.catalog import run_dir, stage


def promotion_reasons(challenger: str, champion: str, baseline: str, source: str, columns: Sequence[str], ratio: float = 0.5, tolerance: float = 0.0) -> Column:
    """Array of reasons against promotion; empty means promote.

    ``challenger`` and ``champion`` are struct columns with version, subset, training_source, input_columns,
    validation_rmse, validation_units and labels_digest; the champion may be null. Ties with the champion promote.
    """
    c = lambda f: F.col(f"{challenger}.{f}")
    m = lambda f: F.col(f"{champion}.{f}")
    known, base = F.col(champion).isNotNull(), F.col(baseline)
    same = m("version") == c("version")
    comparable = m("subset").eqNullSafe(c("subset")) & m("validation_units").eqNullSafe(c("validation_units")) & m("labels_digest").eqNullSafe(c("labels_digest"))
    good = F.coalesce(c("validation_rmse") <= ratio * base, F.lit(False))
    no_worse = F.coalesce(c("validation_rmse") <= m("validation_rmse") + tolerance, F.lit(False))
    return F.array_compact(
        F.array(
            F.when(~c("training_source").eqNullSafe(F.lit(source)), F.lit("training source")),
            F.when(~c("input_columns").eqNullSafe(F.array(*(F.lit(x) for x in columns))), F.lit("feature contract")),
            F.when(~good, F.lit("baseline")),
            F.when(known & same, F.lit("already champion"))
            .when(known & ~comparable, F.lit("not comparable"))
            .when(known & ~no_worse, F.lit("worse than champion")),
        )
    )


def retrain_reason(current: DataFrame, champion: DataFrame, force: bool = False) -> DataFrame:
    """One row (retrain, reason) from tables (name, digest) of what training would use and what the champion used."""
    both = current.join(champion.select("name", F.col("digest").alias("_old")), "name", "left")
    changed = F.array_sort(F.collect_list(F.when(~F.col("digest").eqNullSafe(F.col("_old")), F.col("name"))))
    seen = both.agg(changed.alias("c"), F.count("_old").alias("known"))
    reason = F.when(F.lit(force), "forced").when(F.col("known") == 0, "no champion").when(F.size("c") > 0, F.concat(F.lit("changed: "), F.array_join("c", ", "))).otherwise("unchanged")
    return seen.select((F.lit(force) | (F.col("known") == 0) | (F.size("c") > 0)).alias("retrain"), reason.alias("reason"))


def group_split(unit: Column, share: float = 0.2, seed: int = 42) -> Column:
    """Whether all rows of a unit belong to validation: by a hash of the unit, so no unit is on both sides."""
    bucket = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed).cast("string"), unit.cast("string")), 256), 1, 8), 16, 10).cast("long") % 1000
    return bucket < int(share * 1000)


def constant_baseline(labels: DataFrame, validation: Column, label: str) -> DataFrame:
    """One row (mean, rmse): the error on validation rows of predicting the other rows' mean; raises if a side is empty."""
    split = labels.select(F.col(label).cast("double").alias("y"), validation.alias("v"))
    fit, n = F.avg(F.when(~F.col("v"), F.col("y"))), F.count_if("v")
    sums = split.agg(fit.alias("mean"), n.alias("n"), F.sum(F.when(F.col("v"), F.col("y"))).alias("s"), F.sum(F.when(F.col("v"), F.col("y") * F.col("y"))).alias("ss"))
    error = F.sqrt(F.greatest(F.col("ss") / F.col("n") - 2 * F.col("mean") * F.col("s") / F.col("n") + F.col("mean") * F.col("mean"), F.lit(0.0)))
    ok = F.col("mean").isNotNull() & (F.col("n") > 0)
    return sums.select("mean", F.when(ok, error).otherwise(F.raise_error(F.lit("both sides need labels")).cast("double")).alias("rmse"))


class TextModel:
    """Terms counted by the first pipeline, counts damped, and the second pipeline's prediction in ``_p``. Rows with their counts are written once."""

    def __init__(self, terms, rest):
        self.terms, self.rest = terms, rest

    def transform(self, df: DataFrame) -> DataFrame:
        return self.rest.transform(damped(self.terms.transform(df).drop(*_WORDS)))


#: Columns of words on the way to counts.
_WORDS = ("_w", "_b", "_t")


def damped(df: DataFrame) -> DataFrame:
    """``df``, written, with 1 + ln(count) in place of each count in the sparse vectors ``_c``; read back, so that texts are split once."""
    own = df.withColumn("_c", F.unwrap_udt("_c"))
    logs = F.transform(F.col("_c.values"), lambda n: 1 + F.log(n))
    made = own.withColumn("_c", F.struct(F.col("_c.type").alias("type"), F.col("_c.size").alias("size"), F.col("_c.indices").alias("indices"), logs.alias("values")))
    return stage(made, "damped", schema=df.schema)


def _fitted(pipeline, df: DataFrame):
    """The fitted stages as they are read back from the shared folder: numbers, without summaries and tables of the training."""
    from pyspark.ml import PipelineModel

    path = f"{run_dir(df.sparkSession)}/model-{uuid.uuid4().hex}"
    pipeline.fit(df).save(path)
    return PipelineModel.load(path)


def text_baseline(train: DataFrame, text: str, label: str) -> tuple[TextModel, str | None]:
    """TF-IDF of single words and pairs with logistic regression, and the majority label of the training rows.

    Counts enter as 1 + ln(count); terms of fewer than three texts weigh nothing; vectors have length one. Terms are hashed to
    2^20 places, so that neither the driver nor the model holds a vocabulary that grows with the texts; none is left out.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, NGram, Normalizer, RegexTokenizer, SQLTransformer, StringIndexer

    known = train.filter(F.col(label).isNotNull())
    counted = [
        RegexTokenizer(inputCol=text, outputCol="_w", pattern=r"\W+"),
        NGram(n=2, inputCol="_w", outputCol="_b"),
        SQLTransformer(statement="SELECT *, concat(_w, _b) AS _t FROM __THIS__"),
        HashingTF(inputCol="_t", outputCol="_c", numFeatures=1 << 20),
    ]
    rest = [
        IDF(inputCol="_c", outputCol="_i", minDocFreq=3),
        Normalizer(inputCol="_i", outputCol="_x"),
        StringIndexer(inputCol=label, outputCol="_y", handleInvalid="skip"),
        LogisticRegression(featuresCol="_x", labelCol="_y", predictionCol="_p", maxIter=20, regParam=0.01),
    ]
    terms = Pipeline(stages=counted).fit(known)
    majority = known.groupBy(label).count().orderBy(F.desc("count"), label).first()
    counts = damped(terms.transform(known).select(label, "_c"))
    return TextModel(terms, _fitted(Pipeline(stages=rest), counts)), majority[0] if majority else None
