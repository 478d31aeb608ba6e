"""The feature matrix as one Spark ML estimator: text, structured and quality blocks.

The blocks are computed side by side from the same posts and joined on the row id, so
only small rows are shuffled; as a chain of stages the texts would travel with them.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.functions import fixed
from postgauge.functions import text as T
from postgauge.operators import structured as S
from postgauge.operators.quality import quality_features
from postgauge.operators.vectors import fit_svd, mean_word_vector, project, vector_width


def open_table(spark: SparkSession, reference: str) -> DataFrame:
    """A catalog table or, where the reference is a path, a Parquet folder."""
    return spark.read.parquet(reference) if "/" in reference else spark.table(reference)


def _param(name: str, doc: str, convert=TypeConverters.toString) -> Param:
    return Param(Params._dummy(), name, doc, convert)


RAW_TEXT = "mean_word_vector"


class _FeatureParams(Params):
    idCol = _param("idCol", "unique row id")
    textCols = _param("textCols", "text columns averaged into word vectors", TypeConverters.toListString)
    numericCols = _param("numericCols", "numeric columns", TypeConverters.toListString)
    categoricalCols = _param("categoricalCols", "categorical columns", TypeConverters.toListString)
    dateCols = _param("dateCols", "date columns", TypeConverters.toListString)
    qualityFeatures = _param("qualityFeatures", "add the quality features of Title and Body", TypeConverters.toBoolean)
    components = _param("components", "text components kept, 0 for all dimensions", TypeConverters.toInt)
    vectors = _param("vectors", "table or path of (word, vector)")
    lexicon = _param("lexicon", "table or path of (word, syl)")
    outputCol = _param("outputCol", "feature vector column")

    def _defaults(self) -> None:
        self._setDefault(
            idCol="Id",
            textCols=[],
            numericCols=[],
            categoricalCols=[],
            dateCols=[],
            qualityFeatures=False,
            components=fixed.SVD_COMPONENTS,
            vectors="word_vectors",
            lexicon="lexicon",
            outputCol="features",
        )

    def _get(self, name: str):
        return self.getOrDefault(name)

    def _means(self, df: DataFrame) -> DataFrame:
        """Row id and mean word vector; prepared rows bring theirs along."""
        row_id = self._get("idCol")
        if RAW_TEXT in df.columns:
            return df.select(row_id, RAW_TEXT)
        table = open_table(df.sparkSession, self._get("vectors"))
        text = T.concat_text(*sorted(self._get("textCols")))
        return mean_word_vector(df, text, row_id, table).withColumnRenamed("vector", RAW_TEXT)

    def _quality(self, df: DataFrame) -> DataFrame:
        row_id = self._get("idCol")
        if set(fixed.QUALITY_FEATURES) <= set(df.columns):
            return df.select(row_id, *fixed.QUALITY_FEATURES)
        return quality_features(df, open_table(df.sparkSession, self._get("lexicon")), row_id)

    def prepare(self, df: DataFrame) -> DataFrame:
        """Rows with what has to be read from their texts, before anything fitted.

        Stored, it serves both fit and transform. Texts are read once for word vectors and once
        for quality features. What was read meets its row by the id, which must be there and
        unlike all others; other tables are refused.
        """
        out, row_id = df, self._get("idCol")
        wanted = self._get("textCols") and RAW_TEXT not in df.columns
        wanted = wanted or (self._get("qualityFeatures") and not set(fixed.QUALITY_FEATURES) <= set(df.columns))
        if wanted:
            ids = df.groupBy(row_id).agg(F.count(F.lit(1)).alias("_rows"))
            if not ids.where(F.col(row_id).isNull() | (F.col("_rows") > 1)).isEmpty():
                raise ValueError(f"every row needs a {row_id} of its own")
        if self._get("textCols") and RAW_TEXT not in df.columns:
            out = out.join(self._means(df), row_id)
        if self._get("qualityFeatures") and not set(fixed.QUALITY_FEATURES) <= set(df.columns):
            out = out.join(self._quality(df), row_id)
        return out

    def inputs(self) -> list[str]:
        """Columns of prepared rows that fit and transform still need."""
        raw = [RAW_TEXT] if self._get("textCols") else []
        raw += fixed.QUALITY_FEATURES if self._get("qualityFeatures") else []
        return [*self._get("numericCols"), *self._get("categoricalCols"), *self._get("dateCols"), *raw]


class PostFeatures(Estimator, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians, scales, categories and text components from training posts."""

    def __init__(self, **params) -> None:
        super().__init__()
        self._defaults()
        self._set(**params)

    def _fit(self, df: DataFrame) -> PostFeaturesModel:
        state: dict = {}
        if self._get("textCols"):
            state["dims"] = vector_width(open_table(df.sparkSession, self._get("vectors")))
            if self._get("components"):
                state["basis"] = fit_svd(self._means(df), RAW_TEXT, self._get("components")).tolist()
        numbers = self._get("numericCols")
        if numbers:
            state["medians"] = S.fit_medians(df, numbers)
            state["scales"] = S.fit_scales(df, {c: S.impute(c, state["medians"][c]) for c in numbers})
        state["categories"] = {c: S.fit_categories(df, c) for c in self._get("categoricalCols")}
        if self._get("qualityFeatures"):
            state["quality"] = S.fit_scales(self._quality(df), {c: F.col(c) for c in fixed.QUALITY_FEATURES})
        model = PostFeaturesModel(json.dumps(state))
        self._copyValues(model)
        return model


class PostFeaturesModel(Model, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the feature vector; everything learned sits in one JSON parameter."""

    state = _param("state", "learned values")

    def __init__(self, state: str = "{}") -> None:
        super().__init__()
        self._defaults()
        self._set(state=state)

    @property
    def learned(self) -> dict:
        return json.loads(self._get("state"))

    def _structured(self, df: DataFrame) -> dict[str, Column]:
        learned, slots = self.learned, {}
        for c in self._get("numericCols"):
            mean, deviation = learned["scales"][c]
            slots[f"num__{c}"] = S.scale(S.impute(c, learned["medians"][c]), mean, deviation)
        for c in self._get("categoricalCols"):
            slots.update({f"cat__{n}": v for n, v in S.one_hot(c, *learned["categories"][c]).items()})
        for c in self._get("dateCols"):
            slots.update({f"date__{n}": v for n, v in S.date_parts(df, c).items()})
        # A date that is null or can't be read gives NaN slots.
        nan = F.lit(float("nan"))
        return {f"structured_processing__{n}": F.coalesce(v.cast("double"), nan) for n, v in slots.items()}

    def _text_names(self) -> list[str]:
        learned = self.learned
        if "basis" in learned:
            return [f"text_processing__truncatedsvd{i}" for i in range(len(learned["basis"][0]))]
        return [f"text_processing__text_dim_{i}" for i in range(learned.get("dims", 0))]

    def feature_names(self, df: DataFrame) -> list[str]:
        quality = fixed.QUALITY_FEATURES if self._get("qualityFeatures") else []
        return self._text_names() + list(self._structured(df)) + [f"quality_processing__{c}" for c in quality]

    def _transform(self, df: DataFrame) -> DataFrame:
        learned, output = self.learned, self._get("outputCol")
        names, slots = self.feature_names(df), self._structured(df)
        out = self.prepare(df)
        blocks = []
        if self._get("textCols"):
            text = F.col(RAW_TEXT)
            blocks.append(project(text, np.array(learned["basis"])) if "basis" in learned else text)
        if slots:
            blocks.append(F.array(*slots.values()))
        if self._get("qualityFeatures"):
            blocks.append(F.array(*[S.scale(F.col(c), *learned["quality"][c]) for c in fixed.QUALITY_FEATURES]))
        if not blocks:
            raise ValueError("no feature block is configured")
        attributes = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]}, "num_attrs": len(names)}}
        vector = array_to_vector(F.concat(*blocks))
        added = [c for c in out.columns if c not in df.columns]
        return out.withColumn(output, vector.alias(output, metadata=attributes)).drop(*added)


def vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """Slot names carried by a vector column."""
    groups = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a for g in groups.values() for a in g), key=lambda a: a["idx"])
    return [a["name"] for a in slots]
