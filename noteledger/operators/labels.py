"""Code dictionaries and label matrices.

The dictionary is the label space, so it is small by construction; joins
against it are left to AQE, which broadcasts it only when its measured size
is under the threshold. Label matrices are kept sparse (positive pairs only); the
dense 0/1 array is built per row from the dictionary array when asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import parse_code_set, raw_code_pieces
from ..functions.generators import explode_rows
from ..functions.patterns import CODE_STRICT
from .ranking import exact_rank


def code_dictionary(df: DataFrame, codes: str = "codes", raw: bool = False,
                    pattern: str = CODE_STRICT) -> DataFrame:
    """(code, code_index): distinct codes numbered 0.. in code order.

    ``raw=True`` takes the pieces as written (untrimmed, unvalidated), the
    way the reference builds its mapping; the default uses validated codes so
    no label column is permanently zero.
    """
    pieces = raw_code_pieces(codes) if raw else parse_code_set(codes, pattern)
    distinct = explode_rows(df, pieces, "code").distinct()
    ranked = exact_rank(distinct, "code", "code", prefix_len=1, out="_r")
    return ranked.select("code", (F.col("_r") - 1).alias("code_index"))


def label_pairs(df: DataFrame, dictionary: DataFrame, id_col: str, codes: str = "codes",
                pattern: str = CODE_STRICT) -> DataFrame:
    """Sparse label matrix: (id, code, code_index) for every positive cell.

    No broadcast hint: AQE measures the materialized dictionary at run time
    and broadcasts it when it is under the broadcast threshold, and keeps a
    sort-merge join otherwise.
    """
    exploded = explode_rows(df, F.array_distinct(parse_code_set(codes, pattern)), "code", [id_col])
    return exploded.join(dictionary, "code").select(id_col, "code", "code_index")


def dictionary_array(dictionary: DataFrame):
    """Scalar subquery: the codes as one array in index order."""
    codes = F.transform(F.array_sort(F.collect_list(F.struct("code_index", "code"))), lambda s: s["code"])
    return F.lit(dictionary.select(codes).scalar())


def dense_labels(indexes: Column, width: Column) -> Column:
    """0/1 array of ``width`` from the sorted positions of its ones, as runs of zeros between them."""
    bounds = F.concat(F.array(F.lit(-1)), indexes, F.array(width))
    zeros = F.transform(F.sequence(F.lit(0), F.size(indexes)), lambda k: F.array_repeat(F.lit(0), F.get(bounds, k + 1) - F.get(bounds, k) - 1))
    return F.flatten(F.transform(zeros, lambda z, k: F.when(k == 0, z).otherwise(F.concat(F.array(F.lit(1)), z))))


def one_hot_labels(df: DataFrame, dictionary: DataFrame, codes: str = "codes", pattern: str = CODE_STRICT,
                   labels: str = "labels", indexes: str = "label_indexes") -> DataFrame:
    """``df`` with the sorted dictionary indexes of each row's codes (the sparse
    form) and the dense 0/1 label array, in dictionary order, made from them.

    Row by row: each of the row's codes is looked up once in the dictionary
    array, which is as wide as one dense row; no explode, no group and no join,
    so repeated or NULL ids do not matter.
    """
    parsed = F.array_distinct(parse_code_set(codes, pattern))
    found = df.withColumn("_dictionary", dictionary_array(dictionary)).withColumn("_codes", parsed)
    place = F.transform("_codes", lambda c: F.array_position("_dictionary", c).cast("int") - 1)
    found = found.withColumn(indexes, F.array_sort(F.filter(place, lambda i: i >= 0)))
    return found.select(*df.columns, dense_labels(F.col(indexes), F.size("_dictionary")).alias(labels), indexes)


def label_vectors(df: DataFrame, dictionary: DataFrame, codes: str = "codes", pattern: str = CODE_STRICT, out: str = "label_vector") -> DataFrame:
    """``df`` with its labels as a sparse 0/1 vector over the dictionary.

    The vectors are built in the JVM by Spark ML's count vectorizer, which gets the
    dictionary (the label space) as its vocabulary; nothing is fitted.
    """
    from pyspark.ml.feature import CountVectorizerModel

    names = [r.code for r in dictionary.orderBy("code_index").collect()]
    staged = df.withColumn("_labels", F.array_distinct(parse_code_set(codes, pattern)))
    if not names:
        raise ValueError("the dictionary is empty")
    model = CountVectorizerModel.from_vocabulary(names, inputCol="_labels", outputCol=out).setBinary(True).setMinTF(1.0)
    return model.transform(staged).drop("_labels")


def label_union(df: DataFrame, split: str = "split", codes: str = "codes",
                pattern: str = CODE_STRICT) -> DataFrame:
    """Sorted distinct codes over the union of the per-split code sets."""
    per_split = explode_rows(df, parse_code_set(codes, pattern), "code", [split]).distinct()
    parts = [per_split.where(F.col(split) == s).select("code") for s in ("train", "validation", "test")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.distinct().orderBy("code")
