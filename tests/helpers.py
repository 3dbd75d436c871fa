"""Small panels for the tests."""

import datetime as dt

import numpy as np


def day(i, start=dt.date(2024, 1, 1)):
    return start + dt.timedelta(days=i)


def series(spark, values, entity="A", start=0):
    rows = [(entity, day(start + i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "entity STRING, obs_date DATE, price DOUBLE")


def values_of(df, col="price", key=None):
    rows = df.orderBy("obs_date").collect()
    return [r[col] for r in rows if key is None or r["entity"] == key]


def close(a, b, tol=1e-9):
    return all(
        (x is None and y is None) or (x is not None and y is not None and abs(x - y) <= tol * max(1, abs(y)))
        for x, y in zip(a, b)
    ) and len(a) == len(b)


def design_rows(spark, x, y, focal="F", n_comp=1):
    rows = [(focal, day(i), float(y[i]), [float(v) for v in x[i]], n_comp) for i in range(len(y))]
    return spark.createDataFrame(
        rows, "focal_id STRING, obs_date DATE, y DOUBLE, x ARRAY<DOUBLE>, n_comp INT"
    )


def matrix_rows(spark, m, focal="F"):
    p = m.shape[1]
    columns = [(f"c{j}", "USD") for j in range(1, p)]
    rows = [
        (focal, day(i), columns, [None if np.isnan(v) else float(v) for v in m[i]])
        for i in range(len(m))
    ]
    return spark.createDataFrame(
        rows,
        "focal_id STRING, obs_date DATE, columns ARRAY<STRUCT<entity: STRING, currency: STRING>>, row ARRAY<DOUBLE>",
    )


def matrix_of(df):
    return np.array([r["row"] for r in df.orderBy("obs_date").collect()], dtype=float)
