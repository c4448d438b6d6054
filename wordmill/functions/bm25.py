"""The BM25 formula as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The customary BM25 parameters.
K1 = 1.2
B = 0.75


def idf(df: Column, n_docs: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def tf_norm(tf: Column, dl: Column, avgdl: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avgdl))
