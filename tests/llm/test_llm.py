"""Operators against brute force on small tables with nulls, empty and long texts, ties, repeats,
other columns with clashing names, and empty tables."""

import dataclasses
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import DATA
from helpers import duck, same
from veriloom.llm import ann, bpe, exact_dedup, html_render, knlm, langid, ngram_join, packing, pii, queries, suffix_dedup
from veriloom.llm.components import connected

RND = random.Random(7)
SYLLABLES = ["the", "ing", "ou", "er", "th", "an", "é", "st"]


def word():
    return "".join(RND.choice(SYLLABLES) for _ in range(RND.randint(1, 3)))


def prose(n):
    return " ".join(word() for _ in range(n))


BASES = [prose(60) for _ in range(6)]


def edited(t, k):
    w = t.split()
    for _ in range(k):
        w[RND.randrange(len(w))] = word()
    return " ".join(w)


TEXTS = ["", None, " ", "one two", "One  TWO", "a" * 3000, prose(9000), *BASES, *BASES, *[edited(RND.choice(BASES), RND.randint(0, 4)) for _ in range(60)], *[prose(RND.randint(1, 40)) for _ in range(40)], "\t\n", "x\x0by z"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], "src", None if t is None else len(t), i, "s") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, norm long, head string").repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# -- 1
def test_language_id(spark, docs, empty):
    en, fr = "the thing of the theing and with", "éle que les eaux ouche être très"
    rows = [(i, " ".join(RND.sample((en if i % 2 else fr).split(), 5)), "en" if i % 2 else "fr") for i in range(200)] + [(900, None, "en"), (901, "12 34", "en"), (902, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = by_id(langid.identify(df))
    assert [got[k]["lang_pred"] for k in (900, 901, 902)] == ["und"] * 3 and got[900]["score"] == 0 and got[900]["rejected"]
    assert all(got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1 for i, _, lang in rows[:200])
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    assert langid.identify(empty).count() == 0
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}


def test_training_is_stable():
    """Bags of one subword and of half the buckets together stay finite and learn."""
    rng = np.random.default_rng(1)
    bags, labels = [], []
    for k in range(300):
        lang = k % 3
        n = [1, 40, langid.BUCKETS // 2][k % 7 % 3]
        ids = np.unique(rng.integers(0, langid.BUCKETS // 3, n) * 3 + lang)
        bags.append((ids, np.full(len(ids), 1 / len(ids))))
        labels.append(lang)
    m = langid.train(bags, np.array(labels), ("a", "b", "c"))
    assert np.isfinite(m.table).all() and 0 < m.bar <= langid.HIGHEST_BAR
    long = [d for d in range(300) if len(bags[d][0]) > 1000]
    assert all((bags[d][1] @ m.table[bags[d][0]] + m.bias).argmax() == labels[d] for d in long)


def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_clean_documents_are_kept(spark):
    """No labelled document with letters goes, not even one of two languages; unknown letters go."""
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    m = langid.fit(d)
    lettered = [r["doc_id"] for r in d.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert sorted(by_id(langid.accepted(d, m))) == sorted(lettered)
    rnd = random.Random(5)
    by_lang = defaultdict(list)
    for r in d.where("length(text) > 200").orderBy("doc_id").collect():
        by_lang[r["lang"]].append(r["text"][:2000])
    pairs = [(x, y) for a, b in itertools.combinations(sorted(by_lang), 2) for x, y in zip(by_lang[a], by_lang[b], strict=False)]
    mixed = [(i, " ".join(w for p in itertools.zip_longest(x.split(), y.split(), fillvalue="") for w in p)) for i, (x, y) in enumerate(pairs)]
    assert len(by_id(langid.accepted(spark.createDataFrame(mixed, "doc_id long, text string"), m))) == len(mixed)
    doubtful = dataclasses.replace(m, bar=1.1)
    texts = ["".join(rnd.choice("абвгдежзийклмн    ") for _ in range(300)), "a", "привет the", "12", mixed[0][1]]
    assert doubtful.rejects(texts, *m.probabilities(texts)).tolist() == [True, False, True, True, False]


# -- 2 and 6
@pytest.fixture(scope="module")
def reference_ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    t.no_truncation()
    t.no_padding()
    return lambda s: t.encode(s or "", add_special_tokens=False).ids, lambda ids: t.decode(ids, skip_special_tokens=False)


def test_packing(docs, empty, reference_ids):
    rows = [r.asDict() for r in packing.pack_documents(docs).collect()]
    per = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        per[r["doc_id"]].append(r)
    for i, t in enumerate(TEXTS):
        ids = reference_ids[0](t) + [0]
        own = per[i]
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 2048 for r in own[1:]) and (len(own) == 1) == (len(ids) <= 2048)
        for r in own:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert len(seqs) <= math.ceil(sum(r["length"] for r in rows) / 2048) + 1
    assert packing.pack_documents(empty).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    cap = packing.Capacity(tokens=100, documents=3, attention=5200, rule=rule, weights=(1.0, 0.2, 0.2))
    lengths = np.array([RND.randint(1, 70) for _ in range(400)])
    at = packing.vector_best_fit(lengths, cap)
    for s in set(at.tolist()):
        own = lengths[at == s]
        assert own.sum() <= 100 and len(own) <= 3 and ((own**2).sum() <= 5200 or len(own) == 1)


def placed_one_by_one(lengths, cap):
    full = np.array([cap.tokens, cap.documents, cap.attention])
    left, out = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = np.array([lengths[i], 1, lengths[i] ** 2])
        fits = [k for k, r in enumerate(left) if (r >= size).all()]
        if cap.rule == "norm":
            best = min(fits, key=lambda k: (float((np.array(cap.weights) * ((left[k] - size) / full) ** 2).sum()), k), default=None)
        else:
            best = min(fits, key=lambda k: (-float((left[k] * (np.array(cap.weights) * size / full / full)).sum()), k), default=None)
        if best is None:
            best = len(left)
            left.append(full)
        left[best] = left[best] - size
        out[i] = best
    return out


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("documents,attention", [(3, 900), (100, 10_000), (5, 10_000), (100, 1200)])
def test_one_by_one(rule, documents, attention):
    """Capacities that bind: the batches place as a loop over single pieces does."""
    rnd = random.Random(3)
    lengths = np.array([rnd.choice([1, 2, 3, 5, 8, 13, 17, 20, 25, 30]) for _ in range(300)])
    cap = packing.Capacity(100, documents, attention, (1.0, 0.5, 2.0), rule)
    got, want = packing.vector_best_fit(lengths, cap).tolist(), placed_one_by_one(lengths.tolist(), cap)
    assert max(got) == max(want)
    held = lambda places: sorted(sorted(n for n, p in zip(lengths.tolist(), places, strict=True) if p == k) for k in set(places))
    assert held(got) == held(want)


def test_packing_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "x"), (None, None), (2, "")], "doc_id long, text string")
    got = [tuple(r) for r in packing.pack_documents(df).select("doc_id", "length", "offset", "sequence_id").collect()]
    assert sorted(x[0] or 0 for x in got) == [0, 0, 1, 1, 2] and len({(x[3], x[2]) for x in got}) == 5


def test_round_trip(docs, empty, reference_ids):
    got = by_id(bpe.encode_decode_digests(docs))
    for i, t in enumerate(TEXTS):
        ids = reference_ids[0](t)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(reference_ids[1](ids).encode()).hexdigest()
    assert bpe.encode_decode_digests(empty).count() == 0
    assert {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(docs)).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("leaves", [(16384, 512), (8, 4), (5, 3)])
def test_tree_concatenation(reference_ids, leaves):
    e = bpe.Encoder(bpe.default_path(), *leaves)
    alpha = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "a", "b", "the", "ing", "1", "23", "é", "中文", "😀", "!", "?!", "<|endoftext|>", "\xa0", "x" * 50, "ab" * 30]
    texts = ["", "a" * 700, "ab" * 500, *["".join(RND.choice(alpha) for _ in range(RND.randint(0, 40))) for _ in range(150)]]
    ids, at = e.encode(texts)
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == reference_ids[0](t), t


# -- 3
def brute_components(texts):
    sets = {}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("frequent,part,tested", [(4, 4096, 256), (3, 4, 2), (10**9, 3, 256)])
def test_ngram_join(monkeypatch, docs, empty, frequent, part, tested):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", part)
    monkeypatch.setattr(ngram_join, "TESTED", tested)
    monkeypatch.setattr(ngram_join, "BUCKET_SHINGLES", 300)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == brute_components(TEXTS)
    if frequent == 4:
        assert ngram_join.jaccard_components(empty).count() == 0


def test_signature_tree():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, 60))) for _ in range(60)]
    sets += [np.unique(np.concatenate([s[1:], rng.choice(pool, 1)])) for s in sets[:40]]
    tree = ngram_join.SignatureTree(sets, 3)
    links = tree.links(75)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        n = len(np.intersect1d(sets[a], sets[b]))
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            root[max(find(a), find(b))] = min(find(a), find(b))
    want = [find(i) for i in range(len(sets))]
    root[:] = range(len(sets))
    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert [find(i) for i in range(len(sets))] == want


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert connected(links.limit(0)).count() == 0


# -- 4
@pytest.mark.parametrize("share", [500, 8])
def test_exact_dedup(monkeypatch, docs, empty, share):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", share)
    got = by_id(exact_dedup.exact_dedup(docs))
    groups = defaultdict(list)
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in enumerate(TEXTS)}
    for i, t in norm.items():
        groups[t].append(i)
    for i, t in norm.items():
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest())
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {min(g) for g in groups.values()}
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "b")], "doc_id long, text string")
    rows = exact_dedup.exact_dedup(df).collect()
    assert sum(r["kept"] for r in rows) == 2 and {r["group_size"] for r in rows} == {3, 1}


# -- 5
def without_repeated(texts, span):
    """n_bytes, n_removed, n_spans and kept_sha256 of each text, by counting every string of ``span`` bytes."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + span] for t in raw for p in range(len(t) - span + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - span + 1):
            if seen[t[p : p + span]] > 1:
                gone[p : p + span] = b"\1" * span
        runs = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def suffix_rows(df, *args):
    return [((r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]))) for r in suffix_dedup.dedup_digests(df, *args).collect()]


@pytest.mark.parametrize("hot", [2000, 2])
def test_suffix_dedup(monkeypatch, spark, empty, hot):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 1000)
    monkeypatch.setattr(suffix_dedup, "TASK_RUNS", 40)
    span, parts = 20, ["ab", "ba", "é", "aaa", "b", "abab"]
    texts = ["", "a" * 50, "ab" * 30, None, "é" * 40, "x" + "q" * 19, *["".join(RND.choice(parts) for _ in range(RND.randint(0, 50))) for _ in range(100)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(suffix_rows(df, span, 10, hot)) == list(enumerate(without_repeated(texts, span)))
    assert suffix_dedup.dedup_digests(empty).count() == 0


@pytest.mark.parametrize("hot,held", [(2000, 500_000), (3, 20)])
def test_suffix_hot_groups(monkeypatch, spark, hot, held):
    """Very many equal texts, near copies, and one passage (longer than a gram, some longer than a
    span) in many surroundings; ids that repeat or are null; a column with a clashing name."""
    monkeypatch.setattr(suffix_dedup, "HELD", held)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3000)
    letters = "abcdefghijklmnopqrstuvwxyz "
    noise = lambda n: "".join(RND.choice(letters) for _ in range(n))
    equal, near, passage, short = noise(300), noise(200), noise(55), noise(35)
    texts = [equal] * 30
    texts += [near[:k] + "#" + near[k + 1 :] for k in RND.choices(range(200), k=30)]
    texts += [noise(RND.randint(0, 60)) + RND.choice([passage, short]) + noise(RND.randint(0, 60)) for _ in range(40)]
    ids = [*range(len(texts) - 20), *[7] * 10, *[None] * 10]
    rows = [(i, t, "x", 1) for i, t in zip(ids, texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket string, shard long").repartition(3)
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(zip(ids, without_repeated(texts, 40), strict=True), key=order)
    assert sorted(suffix_rows(df, 40, 20, hot), key=order) == want


def test_suffix_spans_stay_few(monkeypatch, spark):
    """What comes back of repeats is a span for each stretch, not a row for each start."""
    letters = "abcdefghijklmnopqrstuvwxyz "
    text = "".join(RND.choice(letters) for _ in range(2000))
    df = spark.createDataFrame([(i, text) for i in range(50)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(suffix_dedup, "per_group", lambda f, key, fn, schema, real=suffix_dedup.per_group: seen.append((key, f)) or real(f, key, fn, schema))
    suffix_dedup.find_repeats(df, 40, 20, 5)
    emitted = [f for key, f in seen if key == "task"]
    assert sum(f.count() for f in emitted) == 50


def test_suffix_query_cuts_from_400_bytes(spark, tmp_path):
    """Passages of over 50 words: by contract 400 bytes go and 399 stay; the operator takes shorter ones."""
    rnd = random.Random(5)
    words = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(n))
    under, full = words(80), words(80) + "."
    texts = [f"<{i}{p}{i}>" for i, p in enumerate([under, under, full, full])]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = by_id(queries.queries()["op5_suffix_dedup"](spark, str(tmp_path)))
    assert [(len(under), len(full)), *[got[i]["n_removed"] for i in range(4)]] == [(399, 400), 0, 0, 400, 400]
    shorter = by_id(suffix_dedup.dedup_digests(spark.read.parquet(str(tmp_path / "documents.parquet")), 250, 125))
    assert [shorter[i]["n_removed"] for i in range(4)] == [399, 399, 400, 400]


# -- 7
PRIVATE = [
    "write to a.b+c@mail.example.com, or x@y, or @z.com",
    "a@b.c.d@e.f",
    "host 10.0.0.255 and 300.1.1.1 and 1.2.3.4.5.6.7.8",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112",
    "call +1 (743) 555-3824 or +12, or +4912345678901234567",
    "iban DE89 3704 0044 0532 0130 00 and DE88370400440532013000",
    "my ssn is 123-45-6789",
    "part no 123-45-6789",
    "9" * 5000,
    "a@" * 2000,
    "é😀 1.1.1.1",
]


def base_by_pattern(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_pii(spark, docs, empty):
    texts = [t for t in PRIVATE if not t.startswith("a@a@")] + [None, ""]
    df = spark.createDataFrame(list(enumerate([*texts, "a@" * 2000])), "doc_id long, text string")
    got = by_id(pii.pii_digests(df))
    for i, t in enumerate(texts):
        want = base_by_pattern(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want).encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(x[1] == j for x in want) for j in range(4)]
    assert got[len(texts)]["spans"] == ""
    kinds = [x.split(":")[0] for i in range(len(texts)) for x in got[i]["spans"].split(",") if x]
    assert kinds.count("iban") == 1 and kinds.count("ssn") == 1
    assert pii.pii_digests(empty).count() == 0
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert pii.redacted("mail a@b.co now") == "mail <EMAIL> now"
    assert {r.doc_id: r.n_chars for r in out.collect()}[1] is None


# -- 8
def test_html(spark):
    page = "<title>T</title><h1>H</h1><ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul><table><tr><th>Name<th>N<tr><td>abcdef<td>1<tr><td colspan=2>wide</table><p>one<br>two<p hidden>no<div style='visibility:hidden'>no<span style='visibility:visible'>yes</span></div><pre> a\n  b</pre><details><summary>S</summary>hid</details>x <b>y</b>z &amp; <!-- no --><script>no</script>"
    want = "H\n\n- a\n- b\n  3. x\n  4. y\n- c\n\nName    N\nabcdef  1\nwide\n\none\ntwo\n\nyes\n\n a\n  b\n\nS\nx yz &"
    rows = [(1, page), (2, None), (3, ""), (4, "<p>un<b>closed"), (5, "<div>" * 2000 + "deep"), (6, "a < b <"), (7, "<p title='x")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    got = {r["page_id"]: r["text"] for r in html_render.extract(df).collect()}
    assert got == {1: want, 2: None, 3: "", 4: "unclosed", 5: "deep", 6: "a < b <", 7: ""}
    assert html_render.extract(df.limit(0)).count() == 0


def test_html_is_bounded():
    """Depth, numbers, and cells that would blow a page up."""
    assert html_render.render("<div>" * 305 + "<div hidden>SECRET</div>shown") == "shown"
    assert html_render.render("<blockquote>" * 3000 + "deep" + "<ul><li>x" * 3000).split()[0] == "deep"
    assert html_render.render("<table><tr><td>x" * 2000).split() == ["x"] * 2000
    assert html_render.render("<ol><li value='--5'>a<li value='²'>b<li value=7>c<li value='-2x'>d</ol>") == "1. a\n2. b\n7. c\n-2. d"
    assert html_render.render("<table><tr><td colspan='²'>x<td rowspan='-1'>y</table>") == "x  y"
    page = "<table><tr><td>" + "w " * 30_000 + "<td>b" + "<tr><td>a<td>b" * 3000 + "</table>"
    text = html_render.render(page)
    assert text.split() == ["w"] * 40 + ["b"] + ["w"] * 29_960 + ["a", "b"] * 3000 and len(text) < 4 * len(page)
    long = html_render.render("<table><tr><td>" + "w" * 60_000 + "<td>b" + "<tr><td>a<td>b" * 3000 + "</table>")
    assert long.split() == ["w" * 60_000, "b"] + ["a", "b"] * 3000 and len(long) < 400_000


def test_html_math_and_drawings():
    page = "<p>E = <math><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>tex</annotation></math></p><svg><title>t</title><desc>d</desc><defs><text>no</text></defs><text>Label</text><rect/><text>Two</text></svg>"
    assert html_render.render(page) == "E = mc2\n\nLabelTwo"


def test_html_layout():
    """Random pages of blocks, lists and tables against a layout made beside them."""
    rnd = random.Random(5)
    token = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9)))
    for _ in range(200):
        page, want = [], []
        for _ in range(rnd.randint(1, 5)):
            kind = rnd.choice(["p", "ul", "ol", "table", "quote"])
            if kind == "p":
                w = [token() for _ in range(rnd.randint(1, 6))]
                page.append("<p>" + rnd.choice([" ", "\n ", " \t"]).join(w))
                want.append([" ".join(w)])
            elif kind in ("ul", "ol"):
                w, n = [token() for _ in range(rnd.randint(1, 4))], rnd.randint(1, 12)
                page.append(f"<{kind}" + (f" start={n}>" if kind == "ol" else ">") + "".join(f"<li>{x}" for x in w) + f"</{kind}>")
                want.append([(f"{n + k}. " if kind == "ol" else "- ") + x for k, x in enumerate(w)])
            elif kind == "quote":
                w = token()
                page.append(f"<blockquote>{w}<br>{w}</blockquote>")
                want.append([f"  {w}"] * 2)
            else:
                cols = rnd.randint(1, 4)
                rows = [[token() for _ in range(cols)] for _ in range(rnd.randint(1, 4))]
                page.append("<table>" + "".join("<tr>" + "".join(f"<td>{c}" + rnd.choice(["", "</td>"]) for c in r) for r in rows) + "</table>")
                wide = [max(len(r[c]) for r in rows) for c in range(cols)]
                want.append(["  ".join(x.ljust(wide[c]) for c, x in enumerate(r)).rstrip() for r in rows])
        assert html_render.render("".join(page)) == "\n\n".join("\n".join(b) for b in want), page


def test_html_words(spark):
    """Every visible word, in order, against a plain walk of the markup."""
    from html.parser import HTMLParser

    class Words(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.mute = [], 0

        def handle_starttag(self, tag, attrs):
            self.mute += tag in ("head", "script", "style")
            self.out.append("" if tag in ("a", "b") else " ")

        def handle_endtag(self, tag):
            self.mute -= tag in ("head", "script", "style")
            self.out.append("" if tag in ("a", "b") else " ")

        def handle_data(self, data):
            if not self.mute:
                self.out.append(data)

    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_render.extract(pages).collect()}
    for r in pages.collect():
        w = Words()
        w.feed(r["html"] or "")
        w.close()
        assert (got[r["page_id"]] or "").replace("-", "").split() == "".join(w.out).replace("-", "").split()


# -- 9
@pytest.mark.parametrize(("order", "share"), [(2, 500), (2, 20), (3, 20), (4, 500)])
def test_kneser_ney(monkeypatch, docs, empty, order, share):
    monkeypatch.setattr(knlm, "HOT_SHARE", share)
    monkeypatch.setattr(knlm, "SHARD_BYTES", 20_000)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    got = by_id(knlm.score(docs, knlm.train(docs.where(~held), order)))
    tok = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "</s>"] for i, t in enumerate(TEXTS)}
    train = [tok[i] for i in tok if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(x for t in train for x in t)
    n, v = sum(c.values()), len(c)

    def grams(t):
        t = ["<s>"] * (order - 1) + t
        return [tuple(t[i : i + order]) for i in range(len(t) - order + 1)]

    of = {order: Counter(g for t in train for g in grams(t))}
    for k in range(order - 1, 0, -1):
        of[k] = Counter(g[1:] for g in of[k + 1])
    d = {k: knlm.discounts([sum(x == y for x in m.values()) for y in (1, 2, 3, 4)]) for k, m in of.items()}
    total, kinds = {}, {}
    for k, m in of.items():
        total[k], kinds[k] = Counter(), defaultdict(lambda: [0, 0, 0])
        for g, x in m.items():
            total[k][g[:-1]] += x
            kinds[k][g[:-1]][min(x, 3) - 1] += 1

    def p(g):
        below = p(g[1:]) if len(g) > 1 else 1 / (v + 1)
        s, x = total[len(g)][g[:-1]], of[len(g)][g]
        return ((x - d[len(g)][min(x, 3) - 1] if x else 0.0) + sum(a * b for a, b in zip(d[len(g)], kinds[len(g)][g[:-1]])) * below) / s if s else below

    for context in (["<s>"] * (order - 1), ["the"] * (order - 1)):
        assert abs(sum(p((*context, w)) for w in [*c, "@unknown"]) - 1) < 1e-9
    for i, t in tok.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))
        assert r["score"] == pytest.approx(sum(math.log10(p(g)) for g in grams(t)))
    nothing = by_id(knlm.score(docs, knlm.train(empty, order)))
    assert nothing[0]["n_known"] == 0 and nothing[0]["score"] == 0.0


# -- 10
def test_nearest(spark):
    rng = np.random.default_rng(5)
    vecs = [rng.normal(size=8).tolist() for _ in range(300)]
    vecs[7] = vecs[0]
    vecs[9] = None
    vecs[10] = [0.0] * 8
    vecs[11] = [float("nan"), *[1.0] * 7]
    vecs[12] = [None, *[1.0] * 7]
    vecs[13] = [1.0] * 5
    vecs[14] = [float("inf"), *[1.0] * 7]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vecs)], "vec_id long, embedding array<float>, q_ids string")
    good = [i for i in range(300) if i not in range(9, 15)]
    m = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in df.collect() if r["vec_id"] in good}
    got = defaultdict(list)
    for r in ann.nearest(df.where("vec_id % 100 = 0"), df, 10).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 100, 200}
    for q in got:
        best = sorted((float(np.sqrt(((m[q] - m[i]) ** 2).sum())), i) for i in good if i != q)[:10]
        assert [(r, v) for r, v, _ in got[q]] == [(k + 1, i) for k, (_, i) in enumerate(best)]
        assert [s for *_, s in got[q]] == pytest.approx([s for s, _ in best])
    assert ann.nearest(df.limit(0), df.limit(0), 10).count() == 0
    assert ann.nearest(df.where("vec_id = 0"), df.where("vec_id < 4"), 10).count() == 3


# -- queries and pipeline
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    same(queries.queries()[name](spark, DATA), duck(DATA).execute(queries.oracle_sql()[name]).fetch_df())


def test_pipeline(spark, docs):
    kept = docs.select("doc_id", "text", F.when(F.col("lang") == "fr", "en").otherwise(F.col("lang")).alias("lang"), "source", "n_chars")
    columns = kept.columns
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stage(spark, kept, DATA)
        if name != "packing":
            assert kept.columns == columns
        if name == "language_id":
            gone = {r["doc_id"] for r in before.join(kept, "doc_id", "left_anti").collect()}
            assert {i for i, t in enumerate(TEXTS) if not re.search(r"[^\W\d_]", t or "")} <= gone
        if name == "ngram_jaccard":
            left = {r["doc_id"]: r["text"] for r in before.collect()}
            want = brute_components([left.get(i) for i in range(len(TEXTS))])
            assert {r["doc_id"] for r in kept.collect()} == {i for i in left if want[i][1] == i}
    assert corpus_pipeline.run(spark, DATA).count() > 0
