"""The text operators against brute force, exact round trips and held-out accuracy; and their edge cases."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from surveyloom.llm import chat_format, common, components, exact_dedup, language_id, licenses, minhash_dedup, mixing, packing, queries, substring_dedup, url_filter, winnowing

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, copy string, bucket int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(60_000))
ODD = [
    (1, "the same text of eight words is here", "en", "b"), (2, "the same  text\nof eight words is here", "en", "b"), (3, None, None, None), (4, "", "de", None), (5, " \t\n", "de", "a"), (6, LONG, "en", "a"), (7, LONG + " x", "en", "a"),
    (8, "12345 !!!", None, "c"), (9, "ein kurzer Satz <|endoftext|> hier", "de", "c"), (9, "ein kurzer Satz <|endoftext|> hier", "de", "c"), (None, "no id at all", "en", "c"), (11, "é" * 300, "fr", "d"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 0, "x", "y", 7) for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def shingles(t, k):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def near_brute(texts, k):
    sets, of = {i: shingles(t, k) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                of[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_duplicates(spark, docs, texts, odd):
    larger = spark.read.parquet(f"{DIR}/../sf0.01/documents.parquet")
    for frame, source in ((docs, texts), (larger, {r["doc_id"]: r["text"] for r in larger.collect()})):
        assert {r[0]: tuple(r)[1:] for r in minhash_dedup.near_duplicates(frame).collect()} == near_brute(source, 4)
    rows = minhash_dedup.near_duplicates(odd).collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    want = near_brute({r[0]: r[1] for r in ODD if r[0] is not None}, 4)
    assert len(rows) == len(ODD) and {i: v for i, v in got.items() if i is not None} == want and got[None][1:] == (None, True)


def test_near_shared_id(spark):
    """Rows that share an id are one document, linked if the set of any is."""
    x, y, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(1, x), (5, x + " end"), (5, y), (7, y), (8, z), (None, x)]
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, None), (1, 1), (5, 1), (5, 1), (7, 1), (8, 8)]


def test_dense_region(spark):
    """One region of many blocks: its copies are one component, and strangers stay out of it."""
    base = [f"w{i}" for i in range(200)]
    rows = [(n, " ".join(base[:n % 60] + [f"x{n}"] + base[n % 60 + 1 :])) for n in range(6000)]
    strangers = [(10_000 + n, " ".join([*base[:140], *(f"s{n} t{i}" for i in range(30))])) for n in range(30)]
    frame = spark.createDataFrame(rows + strangers, "doc_id long, text string").repartition(8)
    got = {r["component_id"]: r["count"] for r in minhash_dedup.near_duplicates(frame).groupBy("component_id").count().collect()}
    assert got == {0: 6000} | {i: 1 for i, _ in strangers}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_regions_read_trees_once(spark, docs, monkeypatch):
    """The 24 rows of each document pass one join on their way to regions; none is passed by a join that is there or not as the groups' sizes are."""
    plans, stored = {}, minhash_dedup.stored
    monkeypatch.setattr(minhash_dedup, "stored", lambda df, name: plans.setdefault(name, _plan(df)) and stored(df, name))
    minhash_dedup.near_duplicates(docs.limit(50))
    assert "LeftAnti" not in plans["regions"] and plans["regions"].count("Generate") == 1


def test_components_of_stars(spark, monkeypatch):
    """Stars around their least vertices take no step; all other shapes give the least id reachable."""
    steps, star = [], components._star
    monkeypatch.setattr(components, "_star", lambda *a: steps.append(1) or star(*a))

    def of(edges):
        return {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}

    assert of([(1, 2), (3, 1), (1, 2), (5, 9), (7, 7)]) == {1: 1, 2: 1, 3: 1, 5: 5, 9: 5} and not steps
    assert of([]) == {} and not steps
    assert of([(i, i + 1) for i in range(20)]) == dict.fromkeys(range(21), 0) and steps
    assert of([(1, 9), (2, 9), (2, 8), (4, 8), (20, 21)]) == dict.fromkeys((1, 2, 4, 8, 9), 1) | {20: 20, 21: 20}


def test_exact_members_are_stored(spark, odd, monkeypatch):
    """The comparison of bytes reads the members of groups, not the joins that find them again for each of its sides."""
    plans, stored = {}, exact_dedup.stored
    monkeypatch.setattr(exact_dedup, "stored", lambda df, name: plans.setdefault(name, _plan(df)) and stored(df, name))
    exact_dedup.exact_groups(odd)
    assert len(re.findall(r"\bJoin\b", plans["collisions"])) <= 6


def test_plans_stay_small(spark, odd, monkeypatch):
    """No plan of the pipeline's deduplication joins more than six times: the driver holds each anew for every one of its stages."""
    joins = {}
    for module in (exact_dedup, minhash_dedup, components):
        monkeypatch.setattr(module, "stored", lambda df, name, stored=module.stored: joins.update({name: max(joins.get(name, 0), len(re.findall(r"\bJoin\b", _plan(df))))}) or stored(df, name))
    exact_dedup.drop_exact(odd)
    text = " ".join(f"w{i}" for i in range(60))
    near = [(i, f"{text} {' '.join(f'v{i + j}' for j in range(4))}", "en", "web", 0, "", "", 0) for i in range(12)]
    minhash_dedup.drop_near(spark.createDataFrame(near, SCHEMA), k=5, percent=80)
    assert {"collisions", "strangers", "stars", "edges", "more-links"} <= joins.keys() and max(joins.values()) <= 6, joins


def test_strangers_meet_once(spark):
    """Members of one component don't meet each other again: a stranger among blocks of copies costs a row for each block."""
    n = 5000
    regions = spark.range(n + 1).select(F.lit(3).alias("tree"), F.lit(9).cast("long").alias("key"), F.col("id").alias("doc_id"), F.lit(n + 1).cast("long").alias("members"))
    of = spark.range(n).select("id", F.lit(0).cast("long").alias("component"))
    sketches = spark.range(n + 1).select(F.col("id").alias("doc_id"), F.lit(5).cast("long").alias("n_shingles"), F.lit(bytes(984)).alias("sketch"))
    met = []
    original = minhash_dedup._compared
    minhash_dedup._compared = lambda rows, *rest: (met.append(rows.count()), original(rows, *rest))[1]
    try:
        # Equal sketches share all trees, and the first is not this one: no pair is told twice.
        assert minhash_dedup._second_round(regions, of, sketches, n + 1, 0.8, 0.7).count() == 0
    finally:
        minhash_dedup._compared = original
    assert n + 1 <= met[0] <= n + 2 * -(-n // minhash_dedup.BLOCK)


def repeats_brute(texts, length=50):
    first = {}
    data = {i: (t or "").encode() for i, t in texts.items()}
    for i in sorted(data):
        for s in range(len(data[i]) - length + 1):
            first.setdefault(data[i][s : s + length], i)
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < i:
                gone[s : s + length] = b"\1" * length
        runs = sum(1 for j in range(len(b)) if gone[j] and not (j and gone[j - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def test_substrings(spark, docs, texts, odd):
    larger = spark.read.parquet(f"{DIR}/../sf0.01/documents.parquet")
    for frame, source in ((docs, texts), (larger, {r["doc_id"]: r["text"] for r in larger.collect()})):
        assert {r[0]: tuple(r)[1:] for r in substring_dedup.remove_repeated(frame).collect()} == repeats_brute(source)
    got = substring_dedup.remove_repeated(odd).collect()
    assert len(got) == len(ODD)
    assert {r[0]: tuple(r)[1:] for r in got if r[0] is not None} == repeats_brute({r[0]: r[1] for r in ODD if r[0] is not None})


@pytest.mark.parametrize("bounds", [{}, {"hot_from": 2}, {"hot_from": 8, "crowd": 1}, {"hot_from": 10**9, "crowd": 5}])
def test_hot_passage(spark, bounds):
    """A passage among different neighbours, cut and periodic ones: the same result however samples are dealt out."""
    rnd = random.Random(1)
    some = lambda n: "".join(rnd.choice("abcdefghij") for _ in range(n))
    passage = some(90)
    rows = [(i, some(60) + passage + some(60)) for i in range(300)] + [(1000 + i, "ab" * rnd.randint(20, 60) + passage[: rnd.randint(30, 90)] + "x" * rnd.randint(0, 80)) for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r[0]: tuple(r)[1:] for r in substring_dedup.remove_repeated(frame, **bounds).collect()} == repeats_brute(dict(rows))


def test_common_prefixes():
    import numpy as np

    texts = [b"abcd", b"abce", b"abce", b"zzzz"]
    classes = substring_dedup._sorted_prefixes(np.array([0, 0, 0, 1]), np.frombuffer(b"".join(texts), np.uint8).reshape(4, 4))
    for depth in range(5):
        for i in range(4):
            for j in range(4):
                assert (classes[i, depth] == classes[j, depth]) == ((i == 3) == (j == 3) and texts[i][:depth] == texts[j][:depth])


def test_exact(odd):
    got = {r["doc_id"]: r for r in exact_dedup.exact_groups(odd).collect()}
    assert (got[2]["keep_id"], got[2]["group_size"], got[2]["kept"]) == (1, 2, False)
    assert (got[4]["keep_id"], got[4]["group_size"]) == (3, 2)
    assert got[9]["group_size"] == 2 and got[9]["kept"]
    assert sorted(r["doc_id"] or 0 for r in exact_dedup.drop_exact(odd).collect()) == [0, 1, 3, 5, 6, 7, 8, 9, 11]


def test_exact_collisions(spark):
    """With a digest of one bit, unlike texts of one length collide: bytes decide."""
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["ab", "cd", "ef", "gh", "ijk", "lmn", None])) for i in range(400)] + [(None, "ab"), (7, "ab")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    weak = lambda c: F.unhex(F.lpad(F.hex(F.ascii(c) % 2), 32, "0"))
    for digest in (weak, exact_dedup._md5):
        got = exact_dedup.exact_groups(frame, digest=digest).collect()
        sizes, first = collections.Counter(t or "" for _, t in rows), {}
        for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
            first.setdefault(t or "", i)
        sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in sizes}
        assert len(got) == len(rows)
        for r in got:
            t = sha[r["text_sha256"]]
            if digest is weak and t == "ab" and (r["doc_id"] in (None, 7)):
                continue  # a row without id isn't compared, nor told apart from another of its id
            assert (r["keep_id"], r["kept"]) == (first[t], r["doc_id"] == first[t])
            assert r["group_size"] == sizes[t] or digest is weak


def test_rows_not_ids(spark):
    """Two rows without id, and one id on two texts: the decision is made by row."""
    x, y, n, m = (" ".join(f"{c}{i}" for i in range(40)) for c in "xynm")
    rows = [(1, x, "a"), (2, y, "a"), (2, x, "b"), (None, n, "a"), (None, m, "a"), (None, n, "a"), (3, n + "!", "a"), (3, y, "a")]
    schema = "doc_id long, text string, source string"
    for turn in (rows, rows[::-1]):
        frame = spark.createDataFrame(turn, schema)
        got = {(r["doc_id"], r["text"]): r for r in exact_dedup.exact_groups(frame).join(frame.select("text", F.sha2("text", 256).alias("text_sha256")).distinct(), "text_sha256").collect()}
        assert {k: (v["keep_id"], v["group_size"], v["kept"]) for k, v in got.items() if k[0]} == {(1, x): (1, 2, True), (2, x): (1, 2, False), (2, y): (2, 2, True), (3, y): (2, 2, False), (3, n + "!"): (3, 1, True)}
        exact = exact_dedup.drop_exact(frame)
        assert sorted(tuple(r) for r in exact.collect() if r["doc_id"]) == [(1, x, "a"), (2, y, "a"), (3, n + "!", "a")]
        assert sorted(r["text"] for r in exact.collect() if r["doc_id"] is None) == [m, n]
        near = minhash_dedup.drop_near(spark.createDataFrame([*turn, (2, y, "c"), (4, y + " end", "a")], schema))
        assert sorted((r["doc_id"] or 0, r["text"]) for r in near.collect()) == [(0, m), (0, n), (0, n), (1, x), (2, y), (3, n + "!")]


def test_apply_mix_rows(spark):
    """Copies are those that the mix gives to rows: the words of a source meet their target."""
    rows = [(None if i % 2 else i // 8, " ".join(["w"] * (i % 7 + 1)) + f" t{i}", "ab"[i % 3 == 0]) for i in range(400)] + [(7, "again and again", "a")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = {r["source"]: r["target"] for r in mixing.mix_sources(frame).select("source", "target").distinct().collect()}
    taken = collections.Counter()
    for r in mixing.apply_mix(frame).collect():
        taken[r["source"]] += len(r["text"].split())
    assert all(abs(taken[s] - t) <= 8 for s, t in targets.items())


def test_mixing(spark, docs, odd):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count()
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs.repartition(3)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    by = collections.defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    total = sum(r["size"] for r in rows)
    left, weight = total, {}
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None] * (None in by)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    size = {s: sum(r["size"] for r in by[s]) for s in names}
    target, free = {}, set(names)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 3 * size[s]
            left -= target[s]
        free -= over
    target |= share
    for s in names:
        assert by[s][0]["target"] == pytest.approx(target[s])
        assert abs(sum(r["taken"] for r in by[s]) - target[s]) <= max(r["size"] for r in by[s])
    got = mixing.mix_sources(odd).collect()
    assert len(got) == len(ODD) and all(r["taken"] == 0 for r in got if r["size"] == 0)


def test_packing(docs, texts, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for frame, source in ((docs, texts), (odd, {r[0]: r[1] for r in ODD})):
        pieces = collections.defaultdict(dict)
        bins = collections.defaultdict(set)
        for r in packing.pack_documents(frame).collect():
            pieces[r["doc_id"]][r["piece"]] = r
            bins[r["sequence_id"]].add((r["offset"], r["length"]))
        for i, text in source.items():
            ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
            mine = [pieces[i][k] for k in sorted(pieces[i])]
            assert [r["start"] for r in mine] == [sum(x["length"] for x in mine[:k]) for k in range(len(mine))]
            assert sum(r["length"] for r in mine) == len(ids) and all(r["length"] == 1024 for r in mine[1:])
            for r in mine:
                assert r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[r["start"] : r["start"] + r["length"]]))
        for spans in bins.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= 1024
        if frame is docs:
            assert len(bins) <= -(-sum(x[1] for s in bins.values() for x in s) // 1024) * 1.02 + 1


def test_tokenizer(texts):
    """Kept words give the ids of whole texts, in any script and for runs of a million signs."""
    import public_tokenizers
    from tokenizers import Tokenizer

    whole, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder()
    rnd = random.Random(2)
    signs = "abc XYZ 12\t\n\r'’²½éßœ “…« \u0085​中文Ⅷ're 'S\x1c\x00<|endoftext|>"
    mixed = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    latin = "".join(c for c in map(chr, range(0x250)) if packing._PLAIN.fullmatch(c)) + " \n\r'"
    mixed += ["".join(rnd.choice(latin) for _ in range(rnd.randint(0, 90))) for _ in range(3000)]
    for text in [*texts.values(), *mixed, " " * 10**6, "a" * 10**6, "<|endoftext|>" * 3]:
        assert encode(text) == whole.encode(text, add_special_tokens=False).ids


def test_best_fit_constraints():
    import numpy as np

    sizes = np.array([[6, 1, 36], [5, 1, 25], [4, 1, 16], [3, 1, 9], [1, 1, 1], [1, 1, 1]], float)
    where, _ = packing.best_fit(sizes, np.array([10.0, 2, 100]), np.ones(3))
    for b in set(where):
        assert (sizes[where == b].sum(axis=0) <= [10, 2, 100]).all()


@pytest.mark.parametrize("given", [{"max_docs": 4}, {"max_attention": 200_000}, {"max_docs": 3, "max_attention": 90_000}, {"max_attention": 10}])
def test_packing_capacities(spark, docs, given):
    """Each capacity binds: of documents in a sequence, and of the sum of squares, which also cuts documents."""
    frame = docs.select("doc_id", F.substring("text", 1, 1500).alias("text")) if given.get("max_attention") != 10 else docs.limit(5)
    rows = packing.pack_documents(frame, with_ids=True, **given).collect()
    bins = collections.defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == r["length"]
        bins[r["sequence_id"]].append(r)
    for b in bins.values():
        lengths = [r["length"] for r in b]
        assert sum(lengths) <= 1024 and len(b) <= given.get("max_docs", 1024) and sum(n * n for n in lengths) <= given.get("max_attention", 1024**2)
        assert sorted(r["offset"] for r in b) == [sum(sorted(lengths, reverse=True)[:i]) for i in range(len(b))]
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in frame.collect()}
    if "max_docs" in given:  # it is what binds: most sequences hold as many documents as they may
        assert sum(len(b) == given["max_docs"] for b in bins.values()) > 0


def naive_language(labelled, text):
    """Scores by the method's rule, from plain counts."""
    languages, out = sorted({lang for lang, _ in labelled}), None
    tables = [collections.defaultdict(lambda: collections.Counter()) for _ in range(6)]
    for lang, t in set(labelled):
        for w in language_id.letters(t):
            tables[0][w][lang] += 1
            for n in range(1, 6):
                for i in range(len(w) + 3 - n):
                    tables[n][f"^{w}$"[i : i + n]][lang] += 1
    totals = [{lang: sum(c[lang] for c in t.values()) for lang in languages} for t in tables]

    def logs(n, key):
        x = [math.log((tables[n][key][lang] + 0.5) / (totals[n][lang] + 0.5 * len(tables[n]))) for lang in languages]
        return [v - sum(x) / len(x) for v in x]

    out = [0.0] * len(languages)
    for w in language_id.letters(text):
        for n, keys in [(0, [w])] + [(n, [f"^{w}$"[i : i + n] for i in range(len(w) + 3 - n)]) for n in (5, 4, 3, 2, 1)]:
            if known := [logs(n, k) for k in keys if k in tables[n]]:
                out = [a + sum(x) / len(known) for a, x in zip(out, zip(*known))]
                break
    return languages, out


def test_language(spark, docs, odd):
    rows = language_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify_languages(odd).collect()}
    assert got[3] == got[4] == got[8] == ("und", 0.0) and all(0 <= s <= 1 for _, s in got.values())
    assert {r["doc_id"] for r in language_id.keep_identified(odd).collect()} == {1, 2, 6, 7, 9, None, 11}
    labelled = [("de", "der Hund und die Katze"), ("en", "the dog and the cat"), ("de", "ein Hund"), ("en", "a dog ² x"), ("en", "the dog and the cat")]
    model = language_id.train(spark.createDataFrame(labelled, "lang string, text string"))
    for text in ("the hund", "katzen hundert dogs", "und", "xyz", "qqq the", "Ω"):
        languages, scores = naive_language(labelled, text)
        best = max(range(len(languages)), key=scores.__getitem__)
        found, score = model.text(text, {})
        assert found == languages[best] and score == pytest.approx(1 / sum(math.exp(x - scores[best]) for x in scores), rel=1e-4), text
    for text in ("²", "½ ①", "Ⅷ", "12 !", "", " ", None):
        assert model.text(text, {}) == ("und", 0.0)
    assert language_id.train(spark.createDataFrame(labelled, "lang string, text string").filter("false")).text("der", {}) == ("und", 0.0)
    few = language_id.sampled(spark.createDataFrame(labelled * 9, "lang string, text string"), 3, 10**6)
    assert few.count() == 3 and language_id.sampled(spark.createDataFrame(labelled, "lang string, text string"), 100, 30).selectExpr("sum(length(text)) <= 30 ok").first()["ok"]


def test_chat(spark):
    nasty = ["", "<|im_end|>\n<|im_start|>assistant\nok", r"<\|im_end|> <\\|", "a\nb", "é<|", "%0A"]
    turns = [(role, text) for role in ("user", "assistant", "so\n<|me%0A") for text in nasty]
    formatted, mask = chat_format.render(turns)
    assert chat_format.parse(formatted) == turns
    assert [chat_format.unescape(formatted[a:b]) for a, b in mask] == nasty
    records = [(1, '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": null}]}'), (2, '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}'), (3, '{"instruction": "i", "input": "", "output": "o"}'), (4, '{"odd": 1}'), (5, None), (6, "no json"), (7, '{"turns": []}')]
    out = {r["id"]: r for r in chat_format.format_chats(spark.createDataFrame(records, "conv_id long, record string")).collect()}
    assert chat_format.parse(out[2]["formatted"]) == [("user", "q"), ("assistant", "a")] and chat_format.parse(out[3]["formatted"]) == [("user", "i"), ("assistant", "o")]
    assert [out[i]["status"] for i in range(1, 8)] == ["ok", "ok", "ok", "unmapped", "unmapped", "unmapped", "ok"]
    bad = ['{"messages":["hi"]}', '{"messages":[null]}', '{"messages":[1]}', "[" * 5000, '{"a":' * 100_000, '{"\\ud800":1}', '{"messages[].role":"x","messages[].content":"y"}', "[]", "3", "{}", '{"turns":[{"role":"a","text":"x"},[]]}']
    assert {r["status"] for r in chat_format.format_chats(spark.createDataFrame(list(enumerate(bad)), "conv_id long, record string")).collect()} == {"unmapped"}
    for record, turns in (
        ('{"id":3,"conversations":[{"from":"human","value":"q","weight":1},{"from":"gpt","value":"a"}]}', [("user", "q"), ("assistant", "a")]),
        ('{"messages":[{"role":"gpt","content":[{"type":"text","text":"a"},{"type":"text","text":"b"}],"name":"n"}]}', [("gpt", "a\nb")]),
        ('{"instruction":"i","output":"o","category":"x"}', [("user", "i"), ("assistant", "o")]),
        ('{"messages":[{"role":"user","content":"\\ud800x"}]}', [("user", "\ufffdx")]),
    ):
        assert chat_format.canonical(record, chat_format.known_layouts(), {}) == turns
    many = spark.createDataFrame([(i, n, role, None if n else "t") for i in (0, 1, 2, None) for n, role in enumerate(("human", "bot"))], "conv_id long, turn long, role string, text string")
    gathered = chat_format.gather(many)
    assert gathered.select(F.expr("split(record, '\"')[1]")).distinct().count() == 3
    assert all(chat_format.parse(r["formatted"]) == [("human", "t"), ("bot", "")] for r in chat_format.format_chats(gathered).collect())
    got = {r["conv_id"]: r for r in queries.op3_chat_format(spark, DIR).collect()}
    rows = collections.defaultdict(list)
    for r in spark.read.parquet(f"{DIR}/conversations.parquet").collect():
        rows[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    said = "<|im_end|><|im_start|>assistant ok"
    rows[-1] = [(0, "user", said), (1, "assistant", said)]
    assert set(got) == set(rows)
    for i, x in rows.items():
        x.sort()
        learned = "".join(t for _, r, t in x if r == "assistant")
        assert got[i]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in x).encode()).hexdigest()
        assert (got[i]["n_turns"], got[i]["loss_chars"], got[i]["loss_sha256"]) == (len(x), len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_urls(spark):
    rows = [(1, "http://A.Example.com/en/1"), (2, "https://www.example.com/en/1?x=1"), (3, "http://b.net/es/"), (4, "http://b.net/de/"), (5, None), (6, "nothing"), (7, "http://com"), (8, "http://x.com?y/"), (9, "ftp://notexample.com/en/#f")]
    got = {r["page_id"]: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert {i: (r["host"], r["path"], r["rule"]) for i, r in got.items()} == {
        1: ("a.example.com", "/en/1", "example.com/en/"), 2: ("www.example.com", "/en/1", "www.example.com/en/"), 3: ("b.net", "/es/", "net/es/"), 4: ("b.net", "/de/", None),
        5: ("", "", None), 6: ("", "", None), 7: ("com", "", None), 8: ("x.com", "", None), 9: ("notexample.com", "/en/", "com/"),
    }
    assert [got[i]["verdict"] for i in (1, 2, 3, 9)] == ["block", "allow", "block", "allow"]



def test_url_statistics(spark):
    """Suffix statistics cover all rows; a row's own fold and the held-out one are no part of its share."""
    rows = [(i, f"http://h{i}.net/{'es' if i % 4 == 0 else 'en' if i % 4 == 1 else 'de'}/") for i in range(80)] + [(100 + i, f"http://h{i}.com/x") for i in range(40)] + [(200 + i, f"http://h{i}.org/x") for i in range(54)]
    frame = url_filter.with_features(url_filter.by_rules(url_filter.with_parts(spark.createDataFrame(rows, "page_id long, url string")), url_filter.RULES))
    labelled = collections.Counter()
    fold = lambda url: zlib.crc32(url.split("/")[2].encode()) % 5
    for i, url in rows:
        if ".com" in url or "/es/" in url:
            labelled[url.split("/")[2].rpartition(".")[2], fold(url)] += 1
    got = url_filter.statistics(frame.withColumn("label", (F.col("rule_verdict") == "block").cast("double"))).collect()
    assert {(r["suffix"], r["suffix_count"]) for r in got} == {("net", 80), ("com", 40), ("org", 54)}
    for r in got:
        n = sum(c for (s, f), c in labelled.items() if s == r["suffix"] and f not in (0, r["fold"]))
        assert (r["labelled"], r["bad"]) == (n, n if r["suffix"] == "net" else 0)


def test_url_classifier(spark, monkeypatch):
    """With labels that depend on lexical features, hosts that were held out are judged right; broadcast and shuffle agree; repeated rows and other columns do no harm."""
    rnd = random.Random(4)
    rows = []
    for i in range(1500):
        bad = rnd.random() < 0.4
        path = "/".join("".join(rnd.choice("0123456789" if bad and rnd.random() < 0.7 else "abcdefghij") for _ in range(rnd.randint(3, 12))) for _ in range(rnd.randint(1, 4)))
        rows.append((i, f"http://{rnd.choice('abc')}{i % 400}.{rnd.choice(['org', 'io', 'xyz'])}/{path}", float(bad), "x"))
    frame = spark.createDataFrame(rows + rows[:50], "page_id long, url string, label double, host string")
    found = []
    for limit in (100, 10**9):  # hot groups broadcast; all shuffled
        monkeypatch.setattr(common, "HOT_ROWS", limit)
        judged = url_filter.judge_urls(frame, rules=[], labels=frame.select("url", "label")).collect()
        assert len(judged) == len(frame.collect())
        want = {r[0]: r[2] for r in rows}
        held = [r for r in judged if r["held_out"]]
        assert len(held) > 150 and sum((r["block_score"] >= 0.5) == (want[r["page_id"]] == 1) for r in held) >= 0.85 * len(held)
        found.append(sorted((r["page_id"], r["verdict"]) for r in judged))
    assert found[0] == found[1]


def winnow_brute(text, k=24, w=16):
    import xxhash

    data = text.lower().encode()
    grams = [(xxhash.xxh64(data[i : i + k], seed=42).intdigest() >> 32, i) for i in range(max(1, len(data) - k + 1))] if data else []
    out = []
    for at in range(max(1, len(grams) - w + 1) if grams else 0):
        least = min(grams[at : at + w], key=lambda x: (x[0], -x[1]))
        if not out or out[-1] != least:
            out.append(least)
    return out


def jaccard(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_winnowing(spark, docs, odd):
    """All columns against plain Python: sparse and dense ids, other scripts, empty and long texts."""
    rnd = random.Random(3)
    strange = [(i * 1000003 if i % 2 else i, "".join(rnd.choice("abÄé中ß ") for _ in range(rnd.choice([0, 1, 5, 24, 30, 39, 40, 200])))) for i in range(200)] + [(10**15, "xy" * 70_000), (10**16, None), (-5, "中文" * 9000)]
    for frame in (docs.select("doc_id", "text"), spark.createDataFrame(strange, "doc_id long, text string")):
        source = sorted(((r["doc_id"], r["text"] or "") for r in frame.collect()), reverse=True)
        got = {r["doc_id"]: r for r in winnowing.edited_likeness(frame).collect()}
        assert len(got) == len(source)
        for (i, t), (_, after) in zip(source, source[1:] + source[:1]):
            m = len(t) // 3
            edited = t[: len(t) - m] + after[:m]
            fp, edited_fp, next_fp = map(winnow_brute, (t, edited, after))
            text = lambda f: ",".join(f"{n:X}:{h:X}" for h, n in f)
            assert tuple(got[i])[1:5] == (len(t), hashlib.sha256(edited.encode()).hexdigest(), text(fp), text(edited_fp))
            assert (got[i]["near_edited"], got[i]["near_next"]) == pytest.approx((jaccard(fp, edited_fp), jaccard(fp, next_fp)))
    out = winnowing.edited_likeness(odd).collect()
    assert len(out) == len(ODD)
    assert {r["doc_id"]: r["fingerprint"] for r in out}[3] == "" and len({r["edited_sha256"] for r in out if r["doc_id"] == 9}) in (1, 2)
    twice = spark.createDataFrame([(None, f"text {i}") for i in range(40)] + [(1, "one")], "doc_id long, text string")
    assert winnowing.edited_likeness(twice).count() == 41
    one = winnowing.edited_likeness(twice.filter("doc_id = 1")).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 3


def test_near_dedup_holds_few_bytes():
    """What a task holds at a time beside its Arrow batch: arrays of a chunk of texts, a slice of the pairs."""
    rnd = random.Random(2)
    texts = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(500)) for _ in range(1500)]
    docs = pa.RecordBatch.from_arrays([pa.array(range(1500), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    sets = pa.array([np.arange(i, i + 800, dtype=np.uint64).tobytes() for i in range(4000)], pa.binary())
    pairs = pa.RecordBatch.from_arrays([pa.array(range(4000), pa.int64())] * 2 + [sets] * 2, names=["a", "b", "set_a", "set_b"])
    for run, batch, rows in ((minhash_dedup._signatures(5), docs, 1500), (minhash_dedup._sets(5), docs, 1500), (minhash_dedup._verified(80), pairs, 4000)):
        assert sum(out.num_rows for out in run([batch])) == rows
        tracemalloc.start()
        for _ in run([batch]):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 25e6


def test_window_minima_and_likeness(spark):
    """Least values of windows of several widths against plain Python; each likeness takes one intersection."""
    rnd = random.Random(7)
    lists = [[rnd.randrange(1 << 62) for _ in range(n)] for n in (1, 2, 3, 7, 15, 16, 17, 33, 100)]
    frame = spark.createDataFrame([(x,) for x in lists], "v array<long>")
    for w in (1, 2, 3, 5, 16):
        got = [r[0] for r in frame.select(winnowing._least(F.col("v"), w)).collect()]
        assert got == [[min(x[i : i + w]) for i in range(max(1, len(x) - w + 1))] for x in lists]
    alike = spark.createDataFrame([([], []), ([], [1]), ([1, 2, 3], [2, 3, 4]), ([5], [5])], "a array<long>, b array<long>")
    assert [r[0] for r in alike.select(winnowing.likeness(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.5, 1.0]
    docs = spark.createDataFrame([(1, "a text of one"), (2, "a text of two")], "doc_id long, text string")
    plan = winnowing.edited_likeness(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect(") == 2


def test_next_document(spark):
    """Few ranges or many: each document's next is the one below it."""
    frame = spark.createDataFrame([(i * i * (-1) ** i, f"t{i}") for i in range(300)], "doc_id long, text string").repartition(4)
    order = [r["text"] for r in frame.orderBy(F.desc("doc_id")).collect()]
    for mb in (1e-5, 1e-3, 1.0):
        rows, window = winnowing.with_next(frame, mb)
        got = {r["text"]: r["next"] for r in rows.withColumn("next", F.lead("text").over(window)).filter("not copy").collect()}
        assert got == dict(zip(order, order[1:] + order[:1]))


def test_licences(spark, odd):
    texts = collections.defaultdict(list)
    for name, text in licenses.known_texts():
        texts[name].append(text)
    mit, apache, gpl = (max(texts[name], key=len) for name in ("MIT", "Apache-2.0", "GPL-3.0"))
    rewrapped = "\n\n".join(" ".join(p.split()) for p in mit.split("\n\n"))
    rows = [
        (1, "released under  the MIT Licence"), (2, "Copyright 2020 X\nReleased under the MIT License."), (3, "text\nAll Rights Reserved\nmore"), (4, None), (5, mit.replace("<year> <copyright holders>", "2024 Jane Doe")),
        (6, rewrapped.replace("sublicense", "sub-licence").replace("All rights reserved.", "")), (7, "x\nReleased under the MIT License." + " -" * 400), (8, mit + " extra"), (9, "\n".join(f"// {x}" for x in apache.split("\n"))),
        (10, gpl.upper()), (11, "licence licence"), (12, "Licensed under the Apache Licence, v2.0"),
    ]
    frame = spark.createDataFrame([(*r, "d", "l") for r in rows], "doc_id long, text string, digest string, lines string")
    got = {r["doc_id"]: (r["license_id"], r["n_license_lines"], r["line_license_ids"]) for r in licenses.scan_licenses(frame).collect()}
    assert got == {
        1: ("MIT", 1, "MIT"), 2: ("MIT", 1, "MIT"), 3: (None, 1, "LicenseRef-all-rights-reserved"), 4: (None, 0, ""), 5: ("MIT", 1, "LicenseRef-all-rights-reserved"), 6: ("MIT", 0, ""), 7: (None, 1, "MIT"), 8: (None, 1, "LicenseRef-all-rights-reserved"),
        9: ("Apache-2.0", 0, ""), 10: ("GPL-3.0", 0, ""), 11: (None, 0, ""), 12: ("Apache-2.0", 1, "Apache-2.0"),
    }
    assert licenses.scan_licenses(odd).count() == len(ODD)
    own = licenses.scan_licenses(frame, known=[("L", "licence licence")]).filter("license_id = 'L'").collect()
    assert [r["doc_id"] for r in own] == [11]


def test_scratch(spark, tmp_path, monkeypatch):
    """Stored tables lie in the application's folder, which can be dropped."""
    monkeypatch.setattr(common, "scratch_root", lambda _, root=common.scratch_root: f"file://{tmp_path}/{root(spark).rpartition('/')[2]}")
    assert common.stored(spark.range(5), "five").count() == 5
    folder = tmp_path / spark.sparkContext.applicationId
    assert len([p for p in folder.iterdir() if p.name.startswith("five-")]) == 1
    common.drop_scratch(spark)
    assert not [p for p in folder.iterdir() if p.name.startswith("five-")]


def test_no_scratch_on_cluster():
    """Where executors are elsewhere a shared folder must be named."""

    class Cluster:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master, applicationId = "spark://host:7077", "a"

    with pytest.raises(RuntimeError):
        common.scratch_root(Cluster)


def test_join_groups(spark):
    """Hot groups and others: the rows of a plain join."""
    rows = spark.range(1000).select(F.when(F.col("id") < 600, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("n")).filter("k % 2 = 0")
    for how in ("inner", "left"):
        got = common.join_groups(rows, groups, ["k"], "n", 1000, how)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, rows.join(groups, "k", how).collect()), key=str)


def test_empty_tables(spark, odd):
    empty = odd.filter("false")
    for f in (minhash_dedup.near_duplicates, language_id.identify_languages, licenses.scan_licenses, mixing.mix_sources, packing.pack_documents, exact_dedup.exact_groups, winnowing.edited_likeness, substring_dedup.remove_repeated):
        assert f(empty).count() == 0, f.__name__
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert chat_format.read_back(chat_format.format_chats(spark.createDataFrame([], "conv_id long, record string"))).count() == 0
    assert chat_format.gather(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    for f in (minhash_dedup.drop_near, language_id.keep_identified, mixing.apply_mix, exact_dedup.drop_exact):
        assert f(empty).columns == odd.columns and f(empty).count() == 0, f.__name__


def test_pipeline(spark, docs, texts):
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        frame = stage(spark, frame, DIR)
        assert frame.columns == docs.columns
    first = {}
    for i in sorted(texts):
        if texts[i] is not None and any(c.isalpha() for c in texts[i]):
            first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    kept = {i: texts[i] for i in first.values()}
    want = {i for i, v in near_brute(kept, 5).items() if v[2]}
    assert {r["doc_id"] for r in frame.collect()} == want
    assert set(corpus_pipeline.run(spark, DIR).columns) >= {"doc_id", "piece", "sequence_id", "ids"}
