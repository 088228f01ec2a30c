"""Small hand-made frames."""

import datetime as dt


def ts(text):
    return dt.datetime.fromisoformat(text)


def day(text):
    return dt.date.fromisoformat(text)


def frame(spark, schema, *rows):
    """Rows as tuples; timestamps without zone and dates may be given as text."""
    df = spark.createDataFrame([tuple(r) for r in rows], plain_types(schema))
    casts = [f"CAST({n} AS {t}) AS {n}" for n, t in columns(schema)]
    return df.selectExpr(*casts)


def columns(schema):
    return [tuple(c.strip().split(" ", 1)) for c in split(schema)]


def split(schema):
    out, depth, part = [], 0, ""
    for ch in schema:
        depth += {"(": 1, ")": -1}.get(ch, 0)
        if ch == "," and depth == 0:
            out.append(part)
            part = ""
        else:
            part += ch
    return [*out, part]


def plain_types(schema):
    """Dates, timestamps and decimals arrive as text."""
    text = ("timestamp", "date", "decimal")
    return ", ".join(
        f"{n} {'string' if t.startswith(text) else t}" for n, t in columns(schema)
    )


def out(df, *order):
    rows = df.orderBy(*order).collect() if order else df.collect()
    return [tuple(r) for r in rows]
