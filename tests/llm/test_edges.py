"""Every registered operator and stage on repeated rows, null keys, columns of clashing names and empty
tables; language scores and table layout against plain versions."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import DATA
from helpers import rows
from veriloom.llm import html_render, langid, queries

RND = random.Random(11)
LONG = " ".join(f"w{RND.randrange(40)}" for _ in range(400))
TEXTS = [(1, LONG), (1, LONG), (1, LONG + " end"), (2, LONG), (None, LONG), (None, None), (3, None), (4, ""), (5, "éa 1.2.3.4 a@b.c"), (5, "éa 1.2.3.4 a@b.c"), (6, "the cat"), (7, "THE  cat")]
PAGES = [(1, "<p>a<p>b"), (1, "<p>a<p>b"), (None, "<table><tr><td>a<td>bb<tr><td>ccc</table>"), (3, None), (4, ""), (5, "<ul><li>x</ul>" * 400)]
VECTORS = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (None, [1.0, 1.0]), (100, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (200, [1.0, 1.0])]
#: Names that operators use inside, as columns of other types than theirs.
CLASHING = "row norm head salt run_rank keep_id shard task digest root node a b n c key value count score held_out lang_pred piece start length offset sequence_id spans ids tokens rank query_id block".split()
OPERATORS = sorted(queries.queries())


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("edges")
    docs = spark.createDataFrame([(i, t, ["en", "fr", None][k % 3], "src", None if t is None else len(t)) for k, (i, t) in enumerate(TEXTS)], "doc_id long, text string, lang string, source string, n_chars long")
    pages = spark.createDataFrame([(i, f"u{i}", t, "en") for i, t in PAGES], "page_id long, url string, html string, lang string")
    vectors = spark.createDataFrame([(i, 0, v) for i, v in VECTORS], "vec_id long, cluster long, embedding array<float>")
    for name, df in {"documents": docs, "pages": pages, "embeddings": vectors}.items():
        clash = df.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(CLASHING) if c not in df.columns])
        for kind, part in {"plain": df, "clash": clash, "empty": df.limit(0)}.items():
            part.write.parquet(str(folder / kind / f"{name}.parquet"))
    return folder


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names(spark, tables, name):
    """Other columns, whatever they are called, change no result."""
    run = queries.queries()[name]
    plain, clash = (run(spark, str(tables / kind)).toPandas() for kind in ("plain", "clash"))
    # Group numbers are any numbers, and rows that repeat may change places.
    drop = [c for c in ("sequence_id", "offset") if c in plain.columns]
    assert rows(plain.drop(columns=drop)) == rows(clash[plain.columns].drop(columns=drop))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, tables, name):
    assert queries.queries()[name](spark, str(tables / "empty")).count() == 0


@pytest.mark.parametrize("name", [n for n in OPERATORS if n.startswith(("op1_", "op3_", "op4_", "op5_", "op6_", "op7_", "op9_"))])
def test_repeated_rows(spark, tables, name):
    """One result a row, and equal ones for equal rows."""
    got = queries.queries()[name](spark, str(tables / "plain")).toPandas()
    assert sorted(got["doc_id"].fillna(-1).astype(int)) == sorted(-1 if i is None else i for i, _ in TEXTS)
    fives = got[got["doc_id"] == 5].drop(columns=[c for c in ("kept",) if c in got.columns]).astype(object)
    assert len(fives) == 2 and fives.iloc[0].tolist() == fives.iloc[1].tolist()


def test_repeated_pages_and_vectors(spark, tables):
    assert queries.queries()["op8_html_text"](spark, str(tables / "plain")).count() == len(PAGES)
    got = queries.queries()["op10_nearest_neighbours"](spark, str(tables / "plain")).toPandas()
    # 0 (twice the same row) and 200 ask; 1, 2, 0 and 200 can be found.
    assert set(got["query_id"]) == {0, 200}
    assert got[got["query_id"] == 200].sort_values("rank")["score"].is_monotonic_increasing
    assert not {3, 4, 5, 100} & set(got["vec_id"])


def test_pipeline_on_an_empty_table(spark, tables):
    assert corpus_pipeline.run(spark, str(tables / "empty")).count() == 0


def test_pipeline_with_clashing_names(spark, tables):
    kept = spark.read.parquet(str(tables / "clash" / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = kept.columns
        kept = stage(spark, kept, str(tables / "clash"))
        assert kept.columns == columns, name
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(i for i, _ in left if i is not None) == sorted({i for i, _ in left if i is not None})
    assert corpus_pipeline.STAGES[-1][1](spark, kept, str(tables / "clash")).count() >= len(left)


def grams(text):
    """Subwords one by one: letter runs of a text, and other characters as one blank."""
    points = [c if c.isalpha() else " " for c in f" {text.lower()} "]
    for n in langid.ORDERS:
        for at in range(len(points) - n + 1):
            g = points[at : at + n]
            if n == 1 and g[0] != " " or n == 2 and g != [" ", " "] or n > 2 and " " not in g[1:-1]:
                yield "".join(g)


def bucket(gram):
    """The rolling hash of a gram, in Python integers."""
    one = lambda x: int(langid.mix64(np.array([x], np.uint64))[0])
    h = 0
    for k, c in enumerate(gram):
        salted = one(ord(c) + 0x5BD1E995)
        h = salted if k == 0 else (h * 0x9E3779B97F4A7C15 + salted) % 2**64
    return one((h + len(gram)) % 2**64) % langid.BUCKETS


def test_language_sample_stays_small_on_the_driver(spark, monkeypatch):
    """What the driver's Python takes for a sample is its shares and little else; buckets and shares are right."""
    d = spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) > 600")
    seen = []
    monkeypatch.setattr(langid, "train", lambda bags, *rest: seen.append((tracemalloc.get_traced_memory()[1], bags)))
    langid.letters()
    tracemalloc.start()
    langid.fit(d)
    tracemalloc.stop()
    most, bags = seen[0]
    assert most < 2_000_000 + 16 * sum(len(ids) for ids, _ in bags)
    got = Counter((tuple(ids.tolist()), tuple(share.tolist())) for ids, share in bags)
    own = Counter()
    for t in (r["text"] for r in d.collect()):
        ids, n = np.unique(langid.subwords([t])[0], return_counts=True)
        own[tuple(ids.tolist()), tuple((n / n.sum()).tolist())] += 1
    assert len(bags) > 100 and not got - own


def test_language_scores_one_by_one(spark):
    """Scores of whole texts, a very long one among them, against a plain sum over subwords."""
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    m = langid.fit(d)
    texts = [r["text"][:300] for r in d.where("length(text) > 300").orderBy("doc_id").limit(12).collect()] + ["", "12", "a", "ß", "\U0001d400x", "İ i"]
    texts += [texts[0] * 200, texts[0]]
    known_buckets = {}
    p, known = m.probabilities(texts)
    for i, t in enumerate(texts):
        own = [known_buckets.setdefault(g, bucket(g)) for g in grams(t)]
        assert known[i] == bool(own)
        if own:
            logits = [math.fsum(float(m.table[b, k]) for b in own) / len(own) + m.bias[k] for k in range(len(m.languages))]
            e = np.exp(np.array(logits) - max(logits))
            assert np.allclose(p[i], e / e.sum(), atol=1e-6)
    assert np.allclose(p[-1], p[0])


def test_table_cells_align():
    """Cells of a column begin at one place, whatever stands before them."""
    words = lambda: "".join(RND.choice("abcdefgh") for _ in range(RND.randint(1, 9)))
    for _ in range(30):
        height, width = RND.randint(1, 6), RND.randint(2, 5)
        cells = [[f"{r}{c}{words()}" for c in range(width)] for r in range(height)]
        page = "<table>" + "".join("<tr>" + "".join(f"<td>{x}" for x in row) for row in cells) + "</table>"
        lines = html_render.render(page).split("\n")
        assert len(lines) == height
        for c in range(width):
            assert len({line.index(row[c]) for line, row in zip(lines, cells, strict=True)}) == 1


def test_near_copies_under_one_id(spark):
    """Texts under one doc_id, and texts without, link by what they say; one of each group stays."""
    text = " ".join(f"t{k}" for k in range(60))
    other = " ".join(f"u{k}" for k in range(60))
    # 1 has two near copies; 2 has two texts that share nothing, one of them near 1; two rows without id are near copies.
    data = [(1, text), (1, text + " end"), (2, "start " + text), (2, other), (None, "x " + other + " y"), (None, LONG), (None, LONG + " end"), (3, None), (3, ""), (None, None)]
    df = spark.createDataFrame([(i, t, f"{k}") for k, (i, t) in enumerate(data)], "doc_id long, text string, row_key string")
    from veriloom.llm import ngram_join

    got = sorted((r["n_shingles"], r["doc_id"] or 0, r["component_id"] or 0) for r in ngram_join.jaccard_components(df).collect())
    of = lambda t: len({tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)}) if t else 0
    want = [1, 1, 1, 2, 2, 0, 0, 3, 3, 0]
    assert got == sorted((of(t), i or 0, c) for (i, t), c in zip(data, want, strict=True))
    kept = ngram_join.near_deduplicated(df)
    assert kept.columns == df.columns
    left = sorted(int(r["row_key"]) for r in kept.collect())
    assert [k for k in left if k < 2] in ([0], [1]) and [k for k in left if k in (5, 6)] in ([5], [6])
    assert [k for k in left if k not in (0, 1, 5, 6)] == [3, 7, 8, 9]
