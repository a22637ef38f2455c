import random

import pytest


def passages(seed=3, size=40):
    """Invented words, and texts of them with copies, near copies, shared passages and odd ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéñß", k=rng.randint(2, 7))) for _ in range(400)] + ["The", "THE", "the,", "日本", "\x00x"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    shared = [text(60), text(30)]
    texts = []
    for i in range(size):
        own = text(rng.choice([3, 8, 19, 40, 120]))
        if i % 4 == 1:
            own = f"{own}\n{shared[i % 2]}  {text(9)}"
        if i % 5 == 2 and texts:
            own = texts[rng.randrange(len(texts))]
        if i % 5 == 3 and texts:
            words = texts[rng.randrange(len(texts))].split(" ")
            words[rng.randrange(len(words))] = "changed"
            own = " ".join(words)
        texts.append(own)
    return texts


#: Rows (doc_id, text): ids out of order, repeated and null; texts null, empty, of spaces, repeating themselves, and long.
TRAPS = [(7 * i % 41 + 3, t) for i, t in enumerate(passages())] + [
    (200, None), (201, ""), (202, " \t\n\x0b\f\r "), (203, "one"), (204, "a b c d"), (205, "A B c D"), (206, "a b c d e"),
    (207, "%%% *** ### " * 40), (208, "same line here\n" * 30), (209, "word " * 500), (None, "a b c d"), (None, None),
    (210, "x" * 5000), (211, "é" * 300 + " " + "word <|endoftext|> and  more   text..."), (3, passages()[0]), (3, "another text of id three " * 5),
    (212, " ".join(passages(9, 30))), (213, " ".join(passages(9, 30)) + " end"), (-5, passages()[4]), (214, passages()[4]), (214, passages()[4]),
]


@pytest.fixture(scope="session")
def traps(spark):
    """TRAPS with columns whose names operators use inside."""
    rows = [(doc, text, "src", 1, "x", True) for doc, text in TRAPS]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long, `row` string, `kept` boolean").repartition(5)


@pytest.fixture(scope="session")
def none(traps):
    return traps.limit(0)


@pytest.fixture(scope="session")
def all_null(spark):
    return spark.createDataFrame([(None, None, None)] * 3, "doc_id long, text string, source string")


def rows(df, *columns):
    """Rows in an order that does not depend on the run; numbers to nine digits."""
    found = [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=repr)


def expected(found):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in found), key=repr)


def in_process(df, function, schema):
    """What ``arrow_map`` does, here and now, so that changed limits count."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_schema(_parse_datatype_string(schema))
    found = [pa.table({f.name: r[f.name] if isinstance(r[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(r[f.name], f.type) for f in kind}).cast(kind)
             for r in function(iter(df.toArrow().to_batches(max_chunksize=7)))]
    return df.sparkSession.createDataFrame(pa.concat_tables(found).combine_chunks() if found else kind.empty_table(), _parse_datatype_string(schema))
