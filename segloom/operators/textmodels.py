"""Text classifiers: TF-IDF over character or word n-grams and logistic regression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.functions.columns import col
from segloom.functions.text import WHITE_SPACE
from segloom.operators.models import balanced_weights
from segloom.runtime import cut, sized

# The number of terms that the known results rest on (a fixed value).
VOCABULARY = 50_000


def char_ngrams(text: str | Column, sizes: Sequence[int] = (1, 2)) -> Column:
    """Character n-grams within words; words are padded with one space on each side."""
    words = F.filter(F.split(F.lower(F.coalesce(col(text), F.lit(""))), WHITE_SPACE), lambda w: w != "")

    def pieces(chars: Column, n: int) -> Column:
        # a padded word has at least 3 characters, so every size up to 3 fits
        return F.transform(F.sequence(F.lit(1), F.size(chars) - (n - 1)), lambda i: F.array_join(F.slice(chars, i, n), ""))

    def grams(word: Column) -> Column:
        # the word is taken apart once: a search for the i-th character of a text walks through all before it
        chars = F.regexp_extract_all(F.concat(F.lit(" "), word, F.lit(" ")), F.lit("(?s)."), F.lit(0))
        return F.element_at(F.transform(F.array(chars), lambda c: F.concat(*[c if n == 1 else pieces(c, n) for n in sizes])), 1)

    return F.flatten(F.transform(words, grams))


def word_ngrams(df: DataFrame, text: str = "text", output: str = "grams") -> DataFrame:
    """Lower-cased words of at least two characters, and pairs of neighbours."""
    tokens = RegexTokenizer(inputCol=text, outputCol="_words", gaps=False, pattern="(?U)\\b\\w\\w+\\b", toLowercase=True)
    out = NGram(n=2, inputCol="_words", outputCol="_pairs").transform(tokens.transform(df))
    return out.withColumn(output, F.concat("_words", "_pairs")).drop("_words", "_pairs")


def grams_of(df: DataFrame, kind: str, text: str = "text") -> DataFrame:
    return df.withColumn("grams", char_ngrams(text)) if kind == "char" else word_ngrams(df, text)


@dataclass
class TextModel:
    """Vocabulary, term weights, regression, and the class behind each index."""

    kind: str
    counter: CountVectorizerModel
    weigher: PipelineModel
    regression: LogisticRegressionModel
    classes: list[int]

    def score(self, df: DataFrame, text: str = "text", digits: int = 4) -> DataFrame:
        """Adds predicted_id and confidence."""
        features = self.weigher.transform(self.counter.transform(grams_of(df, self.kind, text)))
        scored = self.regression.transform(features).withColumn("_p", vector_to_array("probability"))
        top = F.array_max("_p")
        ids = F.array(*[F.lit(c) for c in self.classes])
        return scored.select(
            *df.columns,
            F.get(ids, (F.array_position("_p", top) - 1).cast("int")).alias("predicted_id"),
            F.round(top, digits).alias("confidence"),
        )


def train_text_model(
    train: DataFrame, label: str = "y", text: str = "text", kind: str = "char", balanced: bool = True, c: float = 1.0,
    max_iter: int = 1000, *, vocabulary: int,
) -> TextModel:
    """TF-IDF (smoothed, +1, L2-normalised) and multinomial logistic regression.

    Only the `vocabulary` commonest terms take part.
    The penalty equals 1 / (C * sum of weights) because Spark averages the loss.
    """
    classes = sorted(r[label] for r in train.select(label).distinct().collect())
    index = (F.array_position(F.array(*[F.lit(x) for x in classes]), F.col(label)) - 1).cast("double")
    rows = grams_of(train.select(F.col(text).alias("text"), label), kind).withColumns({"label": index, "n": F.lit(1.0)})
    rows = balanced_weights(rows, "label") if balanced else rows.withColumn("weight", F.lit(1.0))
    rows = rows.select("grams", "label", "weight")
    counter = CountVectorizer(inputCol="grams", outputCol="_tf", vocabSize=vocabulary, minDF=1.0).fit(rows)
    counted = cut(counter.transform(rows).select("_tf", "label", "weight"))  # read three times
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(counted).idf.toArray() + 1.0
    weigher = PipelineModel(
        [
            ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_weighted"),
            Normalizer(p=2.0, inputCol="_weighted", outputCol="features"),
        ]
    )
    data = weigher.transform(counted).select("features", "label", "weight").cache()
    total = data.agg(F.sum("weight")).first()[0]
    regression = LogisticRegression(
        family="multinomial", regParam=1.0 / (c * total), elasticNetParam=0.0, standardization=False,
        weightCol="weight", maxIter=max_iter, tol=1e-4,
    ).fit(data)
    data.unpersist()
    return TextModel(kind, counter, weigher, regression, classes)


def score_text(df: DataFrame, model: TextModel, names: DataFrame, text: str = "text") -> DataFrame:
    """Predicted class, rounded confidence and segment name; unknown ids get the default name."""
    named = model.score(df, text).join(sized(names.select(F.col("segment_id").alias("predicted_id"), "name")), "predicted_id", "left")
    return named.withColumn("name", F.coalesce("name", F.lit("미분류")))
