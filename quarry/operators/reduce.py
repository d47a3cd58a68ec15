"""Dimension reduction (SURVEY DIM-*).

PCA is ``pyspark.ml.feature.PCA``; SVD is the distributed
``RowMatrix.computeSVD`` fed with a DataFrame, so no row passes through Python.
The image-to-pixels step is an Arrow-batched pandas UDF over the image
source's struct (numpy only, no imaging library).
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import dot

# FIXED VALUES: ITU-R BT.601 luma weights for B, G, R channel order.
LUMA_BGR = (0.114, 0.587, 0.299)


def _pixels(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series,
            out_w: int, out_h: int) -> pd.Series:
    res = []
    for h, w, c, buf in zip(height, width, channels, data):
        if buf is None or h is None or h <= 0 or w <= 0:
            res.append(None)
            continue
        a = np.frombuffer(buf, dtype=np.uint8).reshape(int(h), int(w), int(c)).astype(np.float64)
        if c >= 3:
            g = a[:, :, 0] * LUMA_BGR[0] + a[:, :, 1] * LUMA_BGR[1] + a[:, :, 2] * LUMA_BGR[2]
        else:
            g = a[:, :, 0]
        # area-average resize: mean of the source cells each target pixel
        # covers, as box sums over an integral image (no per-pixel loop)
        y0 = np.floor(np.linspace(0, h, out_h + 1)[:-1]).astype(int)
        y1 = np.maximum(np.ceil(np.linspace(0, h, out_h + 1)[1:]).astype(int), y0 + 1)
        x0 = np.floor(np.linspace(0, w, out_w + 1)[:-1]).astype(int)
        x1 = np.maximum(np.ceil(np.linspace(0, w, out_w + 1)[1:]).astype(int), x0 + 1)
        integral = np.zeros((int(h) + 1, int(w) + 1))
        integral[1:, 1:] = g.cumsum(0).cumsum(1)
        box = (integral[np.ix_(y1, x1)] - integral[np.ix_(y0, x1)]
               - integral[np.ix_(y1, x0)] + integral[np.ix_(y0, x0)])
        out = box / np.outer(y1 - y0, x1 - x0)
        res.append(np.rint(out).ravel().tolist())
    return pd.Series(res)


def pixel_vectors(images: DataFrame, width: int = 50, height: int = 50, col: str = "image",
                  out: str = "pixels") -> DataFrame:
    """DIM-1: image -> grey ``width x height`` pixel array<double>, row-major."""
    @F.pandas_udf("array<double>")
    def to_pixels(h: pd.Series, w: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return _pixels(h, w, c, d, width, height)

    img = F.col(col)
    return images.select(img["origin"].alias("origin"),
                         to_pixels(img["height"], img["width"], img["nChannels"], img["data"]).alias(out))


def to_vectors(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.transform(col, lambda x: x.cast("double"))))


def centre(df: DataFrame, vec: str = "features", out: str = "centred"):
    """FEA-1 (mean only): subtract the column means."""
    from pyspark.ml.feature import StandardScaler
    m = StandardScaler(inputCol=vec, outputCol=out, withMean=True, withStd=False).fit(df)
    return m.transform(df)


def pca(df: DataFrame, k: int = 10, vec: str = "features", out: str = "pca"):
    """DIM-2: principal components (d x k) and the projected rows."""
    from pyspark.ml.feature import PCA
    model = PCA(k=k, inputCol=vec, outputCol=out).fit(df)
    return model, model.transform(df)


def _row_matrix(df: DataFrame, vec: str):
    """The rows as a distributed matrix; vectors are converted in the JVM."""
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils
    return RowMatrix(MLUtils.convertVectorColumnsFromML(df.select(vec), vec))


def covariance(df: DataFrame, vec: str = "features") -> DataFrame:
    """Sample covariance matrix (d x d, one tree aggregate) as (i, j, value)."""
    spark = df.sparkSession
    cov = _row_matrix(df, vec).computeCovariance().toArray()
    d = cov.shape[0]
    return spark.createDataFrame([(i, j, float(cov[i, j])) for i in range(d) for j in range(d)],
                                 "i int, j int, value double")


def svd(df: DataFrame, k: int, vec: str = "features") -> tuple[list[float], np.ndarray]:
    """DIM-3: truncated SVD -> (singular values, V as d x k). The left vectors are
    not built: ``project`` gives U x diag(s) row by row, with the rows' ids."""
    res = _row_matrix(df, vec).computeSVD(k, computeU=False)
    return [float(x) for x in res.s.toArray()], res.V.toArray()


def project(df: DataFrame, v: np.ndarray, vec: str = "features", out: str = "projected") -> DataFrame:
    """DIM-4: each row times V (equal to its row of U x diag(s)) as
    array<double>, next to the row's own columns. V is d x k model numbers."""
    from pyspark.ml.functions import vector_to_array
    cols = F.array(*[F.array(*[F.lit(float(x)) for x in v[:, j]]) for j in range(v.shape[1])])
    x = vector_to_array(vec)
    return df.withColumn(out, F.transform(cols, lambda c: dot(x, c)))


def singular_values(df: DataFrame, k_max: int, vec: str = "features") -> DataFrame:
    """DIM-5: the top singular values for k = 1..k_max come from one SVD at
    k_max (the leading values do not depend on k)."""
    s, _ = svd(df, k_max, vec)
    return df.sparkSession.createDataFrame([(i + 1, x) for i, x in enumerate(s)], "i int, value double")
