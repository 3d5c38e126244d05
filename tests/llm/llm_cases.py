"""Awkward documents, and generated ones with copies, for the tests of the operators."""

import random

from pyspark.sql import types as T

FIELDS = [
    ("doc_id", T.LongType()),
    ("text", T.StringType()),
    ("lang", T.StringType()),
    ("source", T.StringType()),
    ("n_chars", T.IntegerType()),
]
#: Columns named like the operators' own.
CLASHES = (
    "id row kept n_words bucket class digest slot shard ids _text _words _row _all part"
    " rank length start crc dull host size component target key"
).split()


def words(r, n, vocabulary=400):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def prose(r, n):
    """Words that hardly repeat, as sentences."""
    out = ["".join(r.choices("abdegiklmnoprstu", k=r.randint(4, 9))) for _ in range(n)]
    return " ".join(w + "." if k % 10 == 9 or k == n - 1 else w for k, w in enumerate(out))


def awkward():
    r = random.Random(4)
    normal, other = prose(r, 120), prose(r, 90)
    long = "\n".join(prose(r, 400) for _ in range(60))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t \x0b\f\r "),
        (None, normal + " unnamed"),
        (None, None),
        (None, normal + " unnamed"),
        (4, normal),
        (4, normal),
        (5, normal),
        (6, other + "\n" + normal),
        (7, long),
        (8, "x" * 9000),
        (9, "one two three"),
        (10, "one two three"),
        (11, "a b　c \x1c d\x85e <|endoftext|> \U0001f642 Ünïcödé"),
        (12, "same " * 300),
        (13, other.upper()),
    ]


def frame(spark, rows, clashes=True):
    fields = [T.StructField(n, k) for n, k in FIELDS]
    extra = [T.StructField(n, T.StringType()) for n in CLASHES] if clashes else []
    full = [
        (i, t, "en", "src", None if t is None else len(t), *["?"] * len(extra))
        for i, t in rows
    ]
    return spark.createDataFrame(full, T.StructType(fields + extra))


def copies(seed=1, base=40, copies_of=6):
    """Texts with exact copies, near copies and shared passages."""
    r = random.Random(seed)
    shared = prose(r, 30)
    out, number = [], 1000
    for k in range(base):
        text = prose(r, r.randint(20, 160)).split()
        if k % 5 == 0:
            at = r.randrange(len(text))
            text[at:at] = shared.split()
        for _ in range(r.choice([1, 1, 1, copies_of])):
            changed = list(text)
            for _ in range(r.choice([0, 0, 1, 2])):
                changed[r.randrange(len(changed))] = f"new{r.randrange(10**6)}"
            out.append((number, r.choice([" ", "\n", "  "]).join(changed)))
            number += 7
    r.shuffle(out)
    return out


def collected(df, *names):
    return [tuple(row[n] for n in names) for row in df.select(*names).collect()]
