"""Vector codes, conversation repair and secret scans against brute force and SQL; and their edge cases."""

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from surveyloom.llm import common, conversation_repair as C, language_id, oracle, queries, secret_ledger as L, url_filter as U, vector_codes as V

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    got = queries.QUERIES[name](spark, DIR)
    want = con.execute(oracle.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(want.fetchall())


# --- vector codes


def coded_brute(rows, parts, entries, rounds):
    kept = sorted((i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v))
    w = len(kept[0][1]) // parts
    cut = [[r[1][p * w : (p + 1) * w] for r in kept] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            at = [near(x, books[p])[1] for x in cut[p]]
            for k in range(len(books[p])):
                mine = [x for x, a in zip(cut[p], at, strict=True) if a == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out, labels = [], collections.Counter()
    for n, (i, _, label) in enumerate(kept):
        found = [near(cut[p][n], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        labels[label] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((i, code, error, labels[label], digest) for i, code, error, label in out)


@pytest.mark.parametrize(("size", "spread"), [(40, 1.0), (300, 0.01), (7, 3.0), (60, 5e4)])
def test_codes_equal_brute_force(spark, size, spread):
    """Ties (coarse values), fewer vectors than entries, values whose squares need more than a long."""
    rnd = random.Random(size)
    rows = [(i * 3, [rnd.choice([-1, 0, 0.3, 1, rnd.random()]) * spread for _ in range(8)], rnd.choice([None, 1, 2])) for i in range(size)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = V.compress_vectors(df, parts=4, entries=16, rounds=6)
    assert sorted(tuple(r) for r in got.collect()) == coded_brute(rows, 4, 16, 6)


def test_codes_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5], "x", 9), (2, None, "x", 9), (3, [None, 1.0], "x", 9), (4, [nan, 1.0], "y", 9), (5, [inf, 0.0], "y", 9), (6, [1e300, 0.0], None, 9), (7, [1.0], None, 9), (8, [1.0, 2.0, 3.0, 4.0], None, 9), (9, [], None, 9)]
    rows += [(None, [3.0, 4.0], None, 9), (1, [0.5, -0.5], "x", 9), (1, [9.0, 0.0], None, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, code int")
    got = V.compress_vectors(df, parts=2, entries=2, rounds=3).collect()
    assert sorted((r["vec_id"] or 0, r["code"]) for r in got) == [(0, "0100"), (1, "0001"), (1, "0101"), (1, "0101")]
    assert len({r["codebooks_sha256"] for r in got}) == 1
    assert V.compress_vectors(df.limit(0)).collect() == []
    assert V.compress_vectors(df.filter("vec_id = 2")).collect() == []


def test_pivots_prune_but_change_nothing():
    rng = np.random.default_rng(5)
    parts, book = rng.integers(-2000, 2000, (500, 8)), rng.integers(-2000, 2000, (16, 8))
    pivots = V.choose_pivots(book, 8)
    far = np.sqrt(np.array([[((p - v) ** 2).sum() for v in pivots] for p in parts], dtype=float)).astype(np.float32)
    at, best, evaluated = V.nearest(parts, far, pivots, book)
    want = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (at == want.argmin(axis=1)).all() and (best == want.min(axis=1)).all()
    assert evaluated < 0.75 * want.size


# --- conversation repair


def cheapest(rows):
    """Forward over all edits, the cheapest and least audit of each state; no runs and no matrices."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def put(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def inserted(ways):
        for _ in range(3):
            for state, (cost, audit, said) in list(ways.items()):
                r = "a" if state == "u" else "u"
                put(ways, r, (cost + 5, audit + "I", [*said, ("assistant" if r == "a" else "user", "")]))
        return ways

    now = {"": (0, "", [])}
    for role, text, fault in rows:
        then = {}
        for state, (cost, audit, said) in inserted(now).items():
            put(then, state, (cost + 2, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            if role[:1] and role[:1] in follow[state]:
                put(then, role[:1], (cost + more, audit + "K", [*said, (role, text)]))
            for name in ("user", "assistant"):
                if name[0] in follow[state]:
                    put(then, name[0], (cost + more + 1, audit + "R", [*said, (name, text)]))
        now = then
    return min((w for s, w in inserted(now).items() if s in ("", "a")), key=lambda w: w[:2])


def repaired_brute(table):
    of = collections.defaultdict(list)
    for conv, turn, role, text in table:
        of[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, rows in of.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns, seen, judged = [r[0] for r in rows if r[0] is not None], set(), []
        for _, role, text in rows:
            own = re.sub(r"[\x20\x09-\x0D]", "", text)
            judged.append((role, text, "blank" if not own else "duplicate" if (role, text) in seen else "truncated" if own[-1] not in ".!?" else "none"))
            seen.add((role, text))
        n = collections.Counter(f for _, _, f in judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))  # noqa: B905
        cost, audit, said = cheapest(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest)
    return out


def test_repair_equals_brute_force(spark):
    rnd = random.Random(7)
    roles, texts = ["user", "assistant", "system", "tool", None, "", "u", "User"], [None, "", " ", "a.", "b!", "c", "d?  ", "e. f", "more", "é…"]
    table = [(rnd.choice([None, *range(150)]), rnd.choice([None, *range(9)]), rnd.choice(roles), rnd.choice(texts)) for _ in range(2000)]
    table += [(900, i, "user" if i < 5000 else "assistant", f"x{i}") for i in range(9000)]  # two long runs of truncated rows
    table += [(901, 3, "user", "same.")] * 3000 + [(902, i, "user", "same.") for i in range(3000)]  # a hot row, a hot text
    df = spark.createDataFrame([(*r, 1, True) for r in table], "conv_id long, turn long, role string, text string, n int, is_text boolean").repartition(7)
    got = {r[0]: tuple(r)[1:] for r in C.repair_conversations(df).collect()}
    assert got == repaired_brute(table)
    assert C.repair_conversations(df.limit(0)).collect() == []


def test_repair_of_what_is_left(spark):
    empty = hashlib.sha256(b"").hexdigest()
    df = spark.createDataFrame([(1, 0, "user", "a.", 0), (2, 0, "user", "long " * 200_000 + ".", 1), (3, None, "assistant", "b.", 1)], "conv_id long, turn long, role string, text string, times int")
    got = {r["conv_id"]: r for r in C.repair_conversations(df, copies_col="times").collect()}
    assert tuple(got[1])[1:] == (0, 0, 0, 0, 0, 0, "", empty)
    assert (got[2]["audit"], got[2]["cost"]) == ("D", 2)
    assert (got[3]["audit"], got[3]["gaps"], got[3]["repaired_sha256"]) == ("D", 0, empty)


def test_powers_are_those_of_single_steps():
    powers = C.Powers()
    for sym in "sSuUaAoOx":
        costs = C.END
        for n in range(1, 40):
            costs = powers.before(sym, 1, costs)
            assert powers.before(sym, n, C.END) == costs


# --- secret scans


def secrets_brute(text):
    base = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    base += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [s for _, _, s in sorted(base)]


def secret_texts():
    rnd, out = random.Random(3), [None, "", "password=abcdef", "secret=token:abcdefgh", "TOKEN: 'x1y2z3'", "paſſword=abcdefg apiKey=1234567", "é" * 50 + "api_key=" + "0123456789abcdef" * 2, "AKIA" + "AKIA" * 4, "AKIAAKIA x", "f" * 23, "f" * 24]
    bits = ["password", "Token", "secret", "apikey", "API_KEY", "=", ":", " ", "'", '"', "abc", "abcdef", "AKIA", "ABCDEFGH0123", "0123456789ab", "deadbeef", "\n", "ü", "."]
    return out + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(60))) for _ in range(400)] + ["a b " * 300_000 + "passwd = hunter22"]


def test_secrets_equal_brute_force(spark):
    texts = secret_texts()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "token=abcdef", "x", "y")] * 2 + [(3, "token=abcdef", "x", "y"), (3, texts[3], "x", "y")], "doc_id long, text string, blob string, path string").repartition(5)
    got = L.scan_secrets(df).collect()
    assert len(got) == len(texts) + 4
    for r in got:
        if r["doc_id"] is None or r["doc_id"] == 3:
            continue
        want = secrets_brute(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]
        assert set(want) <= set(r["spans"].split(",")) | {""}
    assert sorted(r["n_assign"] for r in got if r["doc_id"] is None) == [1, 1]
    assert sorted(r["n_assign"] for r in got if r["doc_id"] == 3) == [0, 0, 1]
    assert L.scan_secrets(df.limit(0)).collect() == []


def test_further_rules(spark):
    pem = "-----BEGIN RSA PRIVATE KEY-----\nMIIabc=\n-----END RSA PRIVATE KEY-----"
    rows = [(1, f"x {pem} y"), (2, "ghp_" + "a1B2" * 9), (3, "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh12"), (4, "plain words, a token of thanks")]
    got = {r["doc_id"]: r["spans"] for r in L.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: f"pem:2:{2 + len(pem)}", 2: "prefixed:0:40", 3: "jwt:0:36", 4: ""}


def test_ledger_scans_unseen_pairs_only(spark, tmp_path):
    """Known contents are not read again; a new rule version scans them for that rule alone; all paths get the findings."""
    ledger = f"file://{tmp_path}/ledger"
    size = lambda: L.read_ledger(spark, ledger).count()
    one, two = L.BASE[0], L.Rule("hex", 1, re.compile("[0-9a-f]{24,}"))
    first = spark.createDataFrame([("a", "token=abcdef"), ("b", "token=abcdef"), ("c", "f" * 30)], "path string, text string")
    L.scan_unseen(first, ledger, (one, two))
    assert size() == 2
    later = spark.createDataFrame([("a", "token=abcdef"), ("d", "f" * 30), ("a", "now passwd=abcdefg")], "path string, text string")
    named = L.scan_unseen(later, ledger, (one, two))
    assert size() == 3
    found = lambda rules: sorted((r["path"], [(s["kind"], s["start"], s["end"]) for s in r["spans"]]) for r in L.findings(named, ledger, rules).collect())
    assert found((one, two)) == [("a", [("assign", 0, 12)]), ("a", [("assign", 4, 18)]), ("d", [("hex", 0, 30)])]
    newer = L.Rule("hex", 2, re.compile("[0-9a-f]{40,}"))
    L.scan_unseen(later, ledger, (one, newer))
    rows = L.read_ledger(spark, ledger).filter(F.size("rules") == 1).collect()
    assert size() == 6 and all(list(r["rules"]) == ["hex@2"] for r in rows)
    assert found((one, newer)) == [("a", [("assign", 0, 12)]), ("a", [("assign", 4, 18)]), ("d", [])]
    L.read_ledger(spark, ledger).write.mode("append").parquet(ledger + "2")
    L.read_ledger(spark, ledger).write.mode("append").parquet(ledger + "2")  # a run that wrote twice
    assert sorted((r["path"], len(r["spans"])) for r in L.findings(named, ledger + "2", (one, two)).collect()) == [("a", 1), ("a", 1), ("d", 1)]


# --- language sample


def test_long_text_leaves_the_language_sample_whole(spark):
    """A text above the bound, wherever its hash puts it, changes nothing for the others."""
    short = [(i, f"der kleine hund {'läuft' if i % 3 else 'schläft'} und {i}", "de") if i % 2 else (i, f"the small dog {'runs' if i % 3 else 'sleeps'} and {i}", "en") for i in range(40)]
    base = spark.createDataFrame(short, "doc_id long, text string, lang string")
    for n in range(8):
        long = base.unionByName(spark.createDataFrame([(100, f"w{n} " * 400, "fr")], base.schema))
        model = language_id.train(long, max_chars=1200)
        got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(base, model).collect()}
        assert got == {i: lang for i, _, lang in short}
    assert language_id.train(base.limit(0)).languages == []


# --- urls


def test_trees_beat_a_constant_on_held_out_hosts(spark):
    """On pages whose hosts were held out the trees find what the rules say more often than the more frequent verdict does."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    said = {h + p: v == "block" for h, p, v in U.RULES}
    held = [(r["block_score"] >= 0.5, said[r["rule"]]) for r in U.judge_urls(pages).filter("held_out and rule is not null").collect()]
    share = sum(b for _, b in held) / len(held)
    assert len(held) > 300 and sum(a == b for a, b in held) / len(held) > max(share, 1 - share) + 0.1


def test_url_features_are_those_of_plain_python(spark):
    urls = ["http://A-b.example.com:80/x/y-z/9?q=1&r=2#top", "https://h1.net", "no scheme 123", "", None, "ftp://ü.org//a//?&&x", "http://x.io/" + "a1" * 5000]
    rows = U.with_features(U.with_parts(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))).collect()
    for r in rows:
        u = urls[r["page_id"]] or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        host = re.split("[/?#]", rest)[0].lower() if rest.isascii() else re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest)[0][len(host) :]
        share = [u.count(c) / len(u) for c in set(u)]
        assert (r["host"], r["path"], r["length"], r["depth"], r["labels"]) == (host, path, len(u), path.count("/"), host.count(".") + 1)
        assert r["digit_ratio"] == pytest.approx(sum(c.isdigit() for c in u) / max(1, len(u))) and r["hyphens"] == u.count("-") and r["fragment"] == ("#" in u)
        assert r["entropy"] == pytest.approx(-sum(p * math.log2(p) for p in share)) and r["parameters"] == len(re.findall("[?&][^?&#]+", u))
        assert (r["suffix"], r["token"]) == (host.rpartition(".")[2], path[1:].split("/")[0].lower())


# --- pipeline


def test_pipeline_stages_on_odd_and_empty_tables(spark):
    """Nulls, blanks, repeats and clashing columns pass all stages; an empty table gives empty ones; what is mixed is packed whole, in sequences without gaps."""
    long = " ".join(f"word{i % 977} other{i % 31}" for i in range(4000))
    rows = [
        (1, "the same text of eight words is here", "en", "b"), (2, "the same  text\nof eight words is here", "en", "b"), (3, None, None, None), (4, "", "de", None), (5, " \t\n", "de", "a"), (6, long, "en", "a"), (7, long + " x", "en", "a"),
        (8, "12345 !!!", None, "c"), (9, "ein kurzer Satz hier", "de", "c"), (9, "ein kurzer Satz hier", "de", "c"), (None, "no id at all", "en", "c"), (11, "é" * 300, "fr", "d"),
    ]
    odd = spark.createDataFrame([(*r, 0, "x", 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, digest string, bucket int")
    for docs, sizes in ((odd, [8, 6, 5]), (odd.limit(0), [0, 0, 0])):
        found = []
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = common.stored(stage(spark, docs, DIR), "stage")
            found.append(docs.count())
            if name == "mix":
                mixed = collections.Counter((r["doc_id"], r["text"]) for r in docs.collect())
            if name != "pack":
                assert docs.columns == columns
        assert found[:3] == sizes
    pieces = docs.collect()
    assert pieces == [] and mixed == {}
    kept = odd.filter("doc_id in (1, 6, 9, 11)").dropDuplicates(["doc_id"])
    packed = corpus_pipeline.pack(spark, corpus_pipeline.mix(spark, kept, DIR), DIR).collect()
    by_sequence = collections.defaultdict(list)
    for r in packed:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= 1024
    assert {r["doc_id"] for r in packed} <= {1, 6, 9, 11} and packed
