"""A small table with the awkward rows that every operator has to take."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "key string, token int, size long, words string, n int, node string, cell string, h int, w string, x string, label string, score double")

LONG = " ".join(f"w{k * 7919 % 30011}" for k in range(40_000))

ROWS = [
    (1, "The first text has a few words.\nAnd a second line."),
    (2, None),
    (3, ""),
    (4, " \n\t"),
    (5, "The first text has a few words.\nAnd a second line."),
    (5, "The first text has a few words.\nAnd a second line."),
    (None, "no id here"),
    (None, None),
    (7, "one"),
    (8, "été \U0001f600 中文 #$% <b>|"),
    (9, LONG),
    (10, "tie tie tie tie tie tie tie tie tie tie tie tie"),
    (-3, "negative id"),
]


def table(spark, rows=ROWS):
    data = [(d, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None, *["c", 1, 2, "c", 3, "c", "c", 4, "c", "c", "c", 0.5])
            for k, (d, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
