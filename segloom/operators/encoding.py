"""One-hot encodings of categorical axes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.config import MISSING
from segloom.functions.columns import in_domain_or_last


def onehot_fixed(df: DataFrame, domain: Mapping[str, Sequence[str]], output: str = "features", missing: str = MISSING) -> DataFrame:
    """Vector with one slot per listed value, in domain order.

    A value outside the domain takes the sentinel's slot, else the last one.
    """
    names = list(domain)
    clean = df.withColumns({f"_v_{a}": in_domain_or_last(a, list(domain[a]), missing) for a in names})
    indexed = clean
    for a in names:  # one model per axis: label lists of unequal length do not fit one array
        indexed = StringIndexerModel.from_labels(list(domain[a]), f"_v_{a}", f"_i_{a}").transform(indexed)
    encoder = OneHotEncoder(inputCols=[f"_i_{a}" for a in names], outputCols=[f"_o_{a}" for a in names], dropLast=False)
    encoded = encoder.fit(indexed).transform(indexed)  # sizes come from the labels, no pass over the data
    out = VectorAssembler(inputCols=[f"_o_{a}" for a in names], outputCol=output).transform(encoded)
    return out.drop(*[f"_{k}_{a}" for k in "vio" for a in names])


def fit_onehot(df: DataFrame, axes: Iterable[str], drop_missing: bool = False, output: str = "features", missing: str = MISSING) -> PipelineModel | None:
    """Encoder of the seen values in sorted order; None when nothing is left to encode.

    With `drop_missing` a missing value becomes a zero block, and an axis without
    any explicit value has no block. Unseen values are zero blocks in both cases.
    """
    axes = list(axes)
    source = prepare(df, axes, drop_missing, missing)
    seen = source.agg(*[F.count(f"_v_{a}").alias(a) for a in axes]).first()
    active = [a for a in axes if seen[a] > 0]
    if not active:
        return None
    # 'keep' adds one slot for unseen values; dropLast removes exactly that slot
    stages = [
        StringIndexer(inputCols=[f"_v_{a}" for a in active], outputCols=[f"_i_{a}" for a in active], stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"_i_{a}" for a in active], outputCols=[f"_o_{a}" for a in active], dropLast=True, handleInvalid="error"),
        VectorAssembler(inputCols=[f"_o_{a}" for a in active], outputCol=output),
    ]
    return Pipeline(stages=stages).fit(source)


def prepare(df: DataFrame, axes: Iterable[str], drop_missing: bool = False, missing: str = MISSING) -> DataFrame:
    """Adds the columns the encoder reads."""
    def value(a):
        return F.when(F.col(a) != missing, F.col(a)) if drop_missing else F.coalesce(F.col(a), F.lit(missing))

    return df.withColumns({f"_v_{a}": value(a) for a in axes})


def encode(df: DataFrame, model: PipelineModel, axes: Iterable[str], drop_missing: bool = False, missing: str = MISSING) -> DataFrame:
    axes = list(axes)
    out = model.transform(prepare(df, axes, drop_missing, missing))
    return out.drop(*[f"_{k}_{a}" for k in "vio" for a in axes])


def slot_values(model: PipelineModel) -> list[list[str]]:
    """The value behind each slot, per encoded axis."""
    return [list(labels) for labels in model.stages[0].labelsArray]
