"""Small tables with the hard cases: nulls, empty texts, ties, repeated rows, clashing columns."""

import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"
NAMES = [
    "doc_id", "text", "lang", "source", "n_chars", "rest", "keep", "row", "n", "class", "norm", "hash", "_row_id", "component",
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, rest string, keep string, row long, "
    "n string, class string, norm string, hash string, _row_id string, component string"
)


def prose(seed, n, words=400):
    """``n`` words that depend on ``seed``."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"w{(x >> 8) % words}x{(x >> 5) % 7}")
    return " ".join(out)


def texts():
    base, other = prose(1, 120), prose(2, 90)
    near = base.split()
    near[60] = "changed"
    passage = prose(3, 70)
    return [
        (1, base),
        (2, base.upper()),
        (3, " ".join(near)),
        (4, other + "\n" + passage + "\nA shared line of text\nshort"),
        (5, prose(5, 60) + "\n" + passage + "\n  a SHARED line of text \t\nshort"),
        (6, None),
        (7, ""),
        (8, " \t\n\r\n"),
        (9, "only three words"),
        (10, "Only  three words"),
        (11, "ünïcode Ünïcode 日本 語\x00x"),
        (11, "ünïcode Ünïcode 日本 語\x00x"),
        (12, "one row of id twelve with a line\nA shared line of text"),
        (12, "another row of id twelve entirely"),
        (None, base),
        (None, "a row without an id at all and some words"),
        (13, "x" * 30_000 + " " + prose(6, 4000)),
        (14, "again " * 300),
        (15, prose(8, 40) + " " + prose(9, 20, 900)),
        (16, "a\n\n\nA shared line of text"),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    langs = ["en", None, "fr"]
    extra = ("r", None, 7, "n", "c", "m", "h", "i", "k")
    data = [(i, t, langs[k % 3], None, None if t is None else len(t), *extra) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def shingles(text):
    w = blank_words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def rows(df, *names):
    found = [tuple(r[n] for n in names) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))
