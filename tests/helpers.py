import math

import pandas as pd


def _norm(v, digits):
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, pd.Timestamp) and v == v.normalize() and v.tzinfo is None:
        return str(v.date())
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, digits)
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return v if isinstance(v, (int, str, bool)) else str(v)


def rows(pdf: pd.DataFrame, digits: int = 6):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c], digits) for c in cols) for _, r in pdf.iterrows()]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def assert_same(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, digits: int = 6):
    assert sorted(spark_pdf.columns) == sorted(duck_pdf.columns)
    assert len(spark_pdf) == len(duck_pdf)
    assert rows(spark_pdf, digits) == rows(duck_pdf, digits)
