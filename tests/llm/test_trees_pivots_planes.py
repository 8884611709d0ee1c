"""Reply trees, the pivot table and the bit planes against plain versions, on small awkward tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from landfall.llm import centroids, chat, importance, queries

# Reply trees

MESSAGES = "tree long, node string, parent string, role string, text string, score double, key string, branch int, leaf string"


def spoken(rows):
    return [(*r, "x", 1, "y") for r in rows]


def plain_paths(rows):
    """{tree: [(mean score, roles and texts from the root down)]} for rows (tree, node, parent, role, text, score) without equal ids."""
    known = {(r[0], r[1]): r for r in rows if r[1] is not None}
    replied = {(r[0], r[2]) for r in rows if r[2] is not None and (r[0], r[2]) in known and r[2] != r[1]}
    out = defaultdict(list)
    for r in rows:
        if (r[0], r[1]) in replied:
            continue
        path, at = [], r
        while at is not None and len(path) <= len(rows):
            path.append(at)
            at = known.get((at[0], at[2])) if at[2] is not None and at[2] != at[1] else None
        if len(path) <= len(rows):
            mean = sum(p[5] or 0.0 for p in path) / len(path)
            out[r[0]].append((mean, [(p[3] or "", p[4] or "") for p in reversed(path)]))
    return out


def read_back(spark, df, **options):
    rows = chat.read_conversations(spark, chat.write_conversations(df, score="score", **options)).collect()
    found = defaultdict(list)
    for r in rows:
        found[r.tree].append((r.branch, r.branch_score, [(t.role, t.text) for t in r.turns], list(r.learned), bytes(r.formatted), r.loss))
    return {t: sorted(v, key=lambda b: b[0]) for t, v in found.items()}


AWKWARD = ["\\### Assistant: </turn> ok", "####", "#####</turn></turn>\n### user: x", "\\h\\b\\t\\\\t", "a: b: c", "", None, "é日本\x00\U0001f600", "</turn", "##", "\n\n"]


@pytest.fixture(scope="module")
def forest():
    rng = random.Random(4)
    rows = []
    for tree in (1, 2, None):
        for k in range(60):
            parent = None if k == 0 else f"n{rng.randrange(max(0, k - 6), k)}"
            rows.append((tree, f"n{k}", parent, rng.choice(["user", "assistant", "a: b", "###", None]), rng.choice(AWKWARD) if k % 3 else f"text {k}", rng.choice([None, 1.0, 2.0, k / 7])))
    rows += [(3, "lone", "nobody", "user", "unknown parent", 1.0), (4, "self", "self", "assistant", "its own parent", 1.0)]
    rows += [(5, "c1", "c2", "user", "a", 1.0), (5, "c2", "c1", "user", "b", 1.0), (5, "off", "c1", "user", "below a circle", 1.0), (5, "fine", None, "user", "kept", 1.0)]
    rows += [(6, None, "r", "assistant", "no id", 2.0), (6, "r", None, "user", "root", 1.0), (6, None, "r", "assistant", "no id", 1.0)]
    rows += [(7, f"d{k:03}", f"d{k - 1:03}" if k else None, "user" if k % 2 else "assistant", "w" * k, 0.0) for k in range(130)]  # a long chain
    rng.shuffle(rows)
    return rows


def test_every_path_is_one_conversation(spark, forest):
    found = read_back(spark, spark.createDataFrame(spoken(forest), MESSAGES))
    wanted = plain_paths(forest)
    assert set(found) == set(wanted) and 5 in found
    for tree, branches in wanted.items():
        got = found[tree]
        assert [b[0] for b in got] == list(range(1, len(branches) + 1))
        assert Counter((round(s, 9), str(p)) for s, p in branches) == Counter((round(b[1], 9), str(b[2])) for b in got)
        assert [round(b[1], 9) for b in got] == sorted((round(s, 9) for s, _ in branches), reverse=True)
        for _, _, turns, learned, formatted, loss in got:
            assert learned == [t for r, t in turns if r == "assistant"]
            assert formatted.count(b"</turn>") == len(turns) == len(re.findall(rb"(?m)^### ", formatted))
            assert all(formatted[: s.start].endswith(b"### assistant: ") and formatted[s.start + s.length :].startswith(b"</turn>\n") for s in loss)


def test_best_branches(spark, forest):
    df = spark.createDataFrame(spoken(forest), MESSAGES)
    every, best = read_back(spark, df), read_back(spark, df, branches=2)
    assert {t: [b[1] for b in v] for t, v in best.items()} == {t: [b[1] for b in v[:2]] for t, v in every.items()}


def test_equal_ids_and_no_messages(spark):
    rows = [(1, "a", None, "user", "first", 0.0), (1, "a", None, "user", "first", 0.0), (1, "b", "a", "assistant", "reply", 0.0)]
    found = read_back(spark, spark.createDataFrame(spoken(rows), MESSAGES))
    assert sorted(str(b[2]) for b in found[1]) == ["[('user', 'first'), ('assistant', 'reply')]", "[('user', 'first')]"]
    assert read_back(spark, spark.createDataFrame([], MESSAGES)) == {}


def test_a_hot_root_with_many_replies(spark):
    rows = [(1, "root", None, "user", "q", 0.0)] + [(1, f"r{k}", "root", "assistant", f"answer {k}", float(k % 9)) for k in range(3000)]
    found = read_back(spark, spark.createDataFrame(spoken(rows), MESSAGES), branches=5)
    assert [b[1] for b in found[1]] == [4.0] * 5 and all(len(b[2]) == 2 for b in found[1])


def test_chat_plan_is_native(spark, sf_dir, monkeypatch):
    plans = []
    kept = chat.saved
    monkeypatch.setattr(chat, "saved", lambda df, purpose: plans.append(df._jdf.queryExecution().toString()) or kept(df, purpose))
    plans.append(queries.op13_reply_tree_chats(spark, sf_dir)._jdf.queryExecution().toString())
    assert len(plans) > 5 and not any(re.search("Python|Arrow|Pandas", p) for p in plans)


# Pivot table


def plain_clusters(rows, clusters=40, rounds=5, dims=64):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    places = [list(v) for _, v in first[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(places)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for k in range(len(places)):
            own = [v for (_, v), (_, c) in zip(kept, at, strict=True) if c == k]
            if own:
                places[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = assign()
    inertia = Counter()
    for d, k in at:
        inertia[k] += d
    names = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in places]
    return Counter((i, k, d, inertia[k], sum(inertia.values()), names[k]) for (i, _), (d, k) in zip(kept, at, strict=True))


VECTORS = "vec_id long, embedding array<{}>, cluster int, distance string, v int, to_pivots int"


def test_clusters_equal_the_plain_version(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=64) + 3 * (i % 7)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [(200, rows[0][1])] * 2 + [(None, rows[1][1]), (None, rows[2][1])]
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] + [1.0] * 63), (305, [math.nan] * 64), (306, [math.inf] + [0.0] * 63), (307, [0.0] * 64), (308, [-0.0] * 64), (309, [-1e5] * 64)]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], VECTORS.format("float")).repartition(5)
    wanted = plain_clusters(rows)
    for pivots in (16, 1):
        assert Counter(tuple(r) for r in centroids.cluster(df, pivots=pivots).collect()) == wanted
    few = plain_clusters(rows[:9])
    assert Counter(tuple(r) for r in centroids.cluster(df.filter("vec_id < 9")).collect()) == few
    empty = centroids.cluster(df.limit(0))
    assert empty.collect() == [] and empty.columns == centroids.cluster(df).columns


def test_huge_components_are_held(spark):
    df = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64), (3, [2.0**20] * 64)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in centroids.cluster(df, clusters=1, rounds=0).collect()}
    assert max(r.distance for r in got.values()) <= 64 * (2 * centroids.MOST) ** 2


def test_bounds_spare_exact_distances():
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(2000, 64)) * 40 + 4000 * rng.integers(0, 12, size=(2000, 1))).astype(np.int32)
    places, pivots = vectors[:40].astype(np.int64), centroids.far_apart(vectors[:500].astype(np.int64), 16)
    cluster, best, exact = centroids.nearest(vectors, centroids._to_pivots(vectors, pivots), places, centroids._to_pivots(places, pivots))
    every = np.stack([centroids.squared(vectors, p) for p in places], axis=1)
    assert (every.argmin(axis=1) == cluster).all() and (every.min(axis=1) == best).all()
    assert exact < every.size / 2


# Bit planes

DOCS = "doc_id long, text string, weight string, rank int, planes string, place int"


def plain_resample(docs, target, percent=5):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    held = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in held for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, n, f in held:
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        rows.append((i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = fit[: percent * len(fit) // 100]
    return Counter((*r[:1], *r[2:]) for r in rows), Counter((r[0], r[4], k) for k, r in enumerate(drawn, 1))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)] + ["É", "ﬁ", "日本", "A1", "Zz", "ǅ", "x" * 300]
    line = lambda n: rng.choice(" .\t").join(rng.choice(words) for _ in range(n))
    docs = [(i, line(rng.randint(0, 90))) for i in range(250)] + [(7, docs7 := line(30)), (7, docs7), (None, line(40)), (300, ""), (301, None), (302, " \x00.-_"), (303, "a"), (304, "A a"), (305, "same " * 5000), (306, line(20_000))]
    return docs, [line(15) for _ in range(20)] + [None, "", "same same same"]


@pytest.mark.parametrize("percent", [5, 100, 0])
def test_weights_and_ranks_equal_the_plain_version(spark, corpus, percent):
    docs, target = corpus
    df = spark.createDataFrame([(*d, "x", 1, "y", 2) for d in docs], DOCS).repartition(4)
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(df, wanted, percent=percent).collect()
    every, drawn = plain_resample(docs, target, percent)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == every
    assert Counter((r.doc_id, r.score, r["rank"]) for r in got if r["rank"] is not None) == drawn


def test_no_documents_and_no_target(spark, corpus):
    df = spark.createDataFrame([(*d, "x", 1, "y", 2) for d in corpus[0][:40]], DOCS)
    nothing = spark.createDataFrame([], "text string")
    got = importance.resample(df, nothing).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == plain_resample(corpus[0][:40], [])[0]
    assert importance.resample(df.limit(0), nothing).collect() == []


def test_planes_give_exact_sums():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 1 << 20, importance.BUCKETS)
    gain = rng.integers(-(1 << 15), 1 << 15, importance.BUCKETS)
    of = lambda x: importance._as_words(importance.planes(x))
    assert importance.weight(of(counts), of(np.maximum(gain, 0)), of(np.maximum(-gain, 0))) == int(counts @ gain)
    assert importance.weight(of(np.zeros(importance.BUCKETS, int)), of(counts), of(counts)) == 0


# Queries


def test_queries_keep_every_row(spark, sf_dir):
    assert queries.op11_pivot_clusters(spark, sf_dir).count() == 500
    drawn = queries.op12_importance_resampling(spark, sf_dir)
    assert drawn.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    chats = queries.op13_reply_tree_chats(spark, sf_dir)
    own = chats.filter("conv_id = -7").first()
    said = queries.CONTROL_TEXT
    assert (own.n_turns, own.loss_chars) == (2, len(said)) and own.loss_sha256 == sha256(said.encode()).hexdigest()
    assert own.turns_sha256 == sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert chats.count() == spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count() + 1
