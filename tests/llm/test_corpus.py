"""Every operator against a brute-force version, on small awkward tables."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from landfall.llm import decontaminate, exact, hilbert, lengths, orc_tokens, packing, paragraphs, quality, queries, sharding, simhash, toxicity
from landfall.llm.base import table, without
from landfall.llm.components import components
from landfall.llm.groups import stars
from landfall.llm.tokens import encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, component_id long, copies string, part int"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and blank texts, copies, near copies, a repeated row, a long text, columns with clashing names."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    base = [line(60) + "\n" + line(25) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20 + i, base[0].replace(" ", "  ")) for i in range(6)] + [(30, base[1]), (30, base[1])]
    near = base[2].split(" ")
    for i in range(5):
        near[5 + 9 * i] = "changed"
        rows.append((40 + i, " ".join(near)))
    rows += [(50, ""), (51, None), (52, " \t\n\x0b\x0c\r "), (None, base[3]), (None, None), (53, line(30_000)), (54, "É\xa0ﬁ İ a_b 'S"), (55, "<|endoftext|>")]
    rows += [(60 + i, line(30) + " " + base[4].split("\n")[0] + " " + line(9)) for i in range(3)]
    full = [(i, t, None if k % 4 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None if k % 7 == 0 else k, 0.5, 1, 2, "x", 9) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def rows(docs):
    return docs.select("doc_id", "text").collect()


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def low(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


# --- helpers -----------------------------------------------------------------


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_ids_of_whole_texts(path, rows):
    enc, rng = encoder(path), random.Random(1)
    texts = [r.text for r in rows if r.text] + ["".join(rng.choice(" \n\t'sabT1é́.!_ΣΑ½̇İ日\xa0") for _ in range(rng.randint(0, 14))) for _ in range(2000)]
    assert all(enc.ids(t) == enc.whole(t) for t in texts)
    assert enc.ids(None) == enc.ids("") == b""


@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2), (4, 2), (1, 3)])
def test_curve_visits_every_cell_by_single_steps(spark, n, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
    index = hilbert.curve_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()
    df = spark.createDataFrame([tuple(map(int, c)) for c in cells], ", ".join(f"x{i} int" for i in range(n)))
    native = [r.h for r in df.select(hilbert.curve_column([F.col(c) for c in df.columns], bits).alias("h")).collect()]
    assert native == index.tolist()


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(40)] + [(7, 7), (300, 300)]
    top = list(range(400))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    wanted = {v: find(v) for a, b in edges if a != b for v in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == wanted
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_stars_span_a_path():
    close = np.eye(50, dtype=bool) | np.eye(50, k=1, dtype=bool) | np.eye(50, k=-1, dtype=bool)
    order = np.random.default_rng(0).permutation(50)
    assert {tuple(e.values()) for e in stars(np.arange(50), close[order][:, order]).to_pylist()} == {(0, i) for i in range(1, 50)}


def test_without_matches_null_ids(spark, docs):
    gone = docs.filter("doc_id IS NULL OR doc_id = 3").select("doc_id", F.xxhash64("text").alias("text_key"))
    for bound in (0, 100):
        assert without(docs, gone, "doc_id", "text", bound).count() == docs.count() - 3


# --- 1 sharding, 6 exact dedup ------------------------------------------------


def test_shards_are_runs_of_the_curve(spark, docs, none):
    placed = sharding.shard(docs, ["source", "lang", "n_chars"], ["doc_id", "text"], 24)
    assert placed.columns == [*docs.columns, "curve", "shard_", "slot"]
    got = placed.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in docs.collect())
    by = defaultdict(list)
    for r in got:
        by[r["shard_"]].append(r)
    sizes = [len(by[k]) for k in range(24)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(24))
    assert all(sorted(r.slot for r in b) == list(range(len(b))) for b in by.values())
    curve = [r.curve for r in sorted(got, key=lambda r: (r["shard_"], r.slot))]
    assert curve == sorted(curve)
    assert sharding.shard(none, ["source"], ["doc_id"], 24).collect() == []
    path = sharding.write_shards(docs.select("doc_id", "text", "source"), ["source"], ["doc_id"], 3)
    assert spark.read.parquet(path).count() == docs.count()


def test_sharding_plan_is_native(spark, sf_dir):
    plan = queries.op1_hilbert_shards(spark, sf_dir)._jdf.queryExecution().toString() + queries.op6_bloom_exact(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("bits", [16, 0])  # 0: one bitmap for all, as full as it gets
def test_exact_groups(docs, rows, none, bits):
    marked, mark = exact.mark_copies(docs, "doc_id", "text", bits_per_row=bits)
    got = marked.select("doc_id", "text", f"{mark}.*").collect()
    bare = lambda t: re.sub("[\x20\x09-\x0d]", "", t or "")
    groups = defaultdict(list)
    for r in rows:
        groups[bare(r.text)].append(r)
    assert mark == "copies_" and marked.columns == [*docs.columns, mark] and len(got) == len(rows)
    for r in got:
        group = groups[bare(r.text)]
        first = min(group, key=lambda x: (-len(x.text or ""), x.doc_id is None, x.doc_id or 0))
        assert (r.keep_id, r.group_size, r.text_sha256) == (first.doc_id, len(group), sha256(bare(r.text).encode()).hexdigest())
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    assert exact.drop_copies(docs).columns == docs.columns and exact.drop_copies(docs).count() == len(groups)
    assert exact.mark_copies(none, "doc_id", "text")[0].collect() == []


# --- 2 simhash ------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_masks_cover_every_difference_of_the_radius():
    rng = random.Random(2)
    for _ in range(3000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        assert any(m & flips == 0 for m in (int(np.int64(m).astype(np.uint64)) for m in simhash.masks(4)))


@pytest.mark.parametrize("radius", [4, 1])
def test_simhash_components(docs, rows, none, radius):
    prints = [plain_fingerprint(r.text) for r in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    wanted = Counter((r.doc_id, f"{p:016x}", low([x.doc_id for x, h in zip(rows, group, strict=True) if h == g])) for r, p, g in zip(rows, prints, group, strict=True))
    got = simhash.near_copies(docs, radius=radius)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == wanted
    kept = simhash.drop_near_copies(docs, radius=radius)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _, c in wanted.elements() if d == c)
    assert simhash.near_copies(none).collect() == []


def test_simhash_blocks_find_the_same_links(spark):
    rng = random.Random(9)
    start = rng.getrandbits(63)
    bits = list({start ^ sum(1 << b for b in rng.sample(range(20), 3)) for _ in range(120)})
    df = spark.createDataFrame([(b,) for b in bits], "bits long")
    roots = [{(r.node, r.root) for r in components(simhash.links(df, 4, block)).collect()} for block in (1024, 7)]
    assert roots[0] == roots[1] and len(roots[0]) > 100


def test_simhash_query_on_the_table(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r.fingerprint for r in queries.op2_covering_simhash(spark, sf_dir).collect()}
    assert got == {r.doc_id: f"{plain_fingerprint(r.text):016x}" for r in rows}


# --- 3 packing, 7 ORC, 9 lengths ----------------------------------------------------


def ids_of(path, text):
    enc = encoder(path)
    return np.append(np.frombuffer(enc.whole(text), enc.dtype) if text else np.empty(0, enc.dtype), 1).astype("<u4")


def test_packing_holds_every_id_once(docs, rows, none):
    got = packing.pack(docs, BYTE).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert zlib.crc32(r.token_ids) == r.ids_crc32 and len(r.token_ids) == 4 * r.length
    for s in sequences.values():
        ends = list(itertools.accumulate(r.length for r in sorted(s, key=lambda r: r.offset)))
        assert [r.offset for r in sorted(s, key=lambda r: r.offset)] == [0, *ends[:-1]]
        assert ends[-1] <= 2048 and (ends[-1] & (ends[-1] - 1)) == 0
    for r in rows:
        if r.doc_id in (None, 30):  # more than one row
            continue
        ids, own = ids_of(BYTE, r.text), sorted(pieces[r.doc_id], key=lambda p: p.start)
        assert b"".join(p.token_ids for p in own) == ids.tobytes() and {p.doc_tokens for p in own} == {len(ids)}
        assert [p.start for p in own] == [0, *itertools.accumulate(p.length for p in own[:-1])]
    assert sum(r.length for r in got) == sum(len(ids_of(BYTE, r.text)) for r in rows)
    whole = packing.sequences(packing.pack(docs, BYTE)).collect()
    assert sorted(len(w.token_ids) // 4 for w in whole) == sorted(sum(r.length for r in s) for s in sequences.values())
    assert packing.pack(none, BYTE).collect() == []


def test_orc_round_trip(spark, docs, rows, none):
    path = orc_tokens.write_tokens(docs, WORD)
    got = orc_tokens.digests(orc_tokens.read_tokens(spark, path)).collect()
    wanted, start = [], 0
    in_order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    for r in in_order:
        wanted.append((r.doc_id, len(ids_of(WORD, r.text)), zlib.crc32(ids_of(WORD, r.text).tobytes())))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(wanted)
    got.sort(key=lambda r: r.start)
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert [r.doc_id for r in got] == [r.doc_id for r in in_order]
    assert orc_tokens.read_tokens(spark, path).filter("doc_id = 5").count() == 1
    assert orc_tokens.digests(orc_tokens.read_tokens(spark, orc_tokens.write_tokens(none, WORD))).collect() == []


def test_lengths_answer_every_limit(docs, rows, none):
    n = [len(ids_of(BYTE, r.text)) - 1 for r in rows]
    hist = lengths.histogram(docs, BYTE)
    assert {r.length: r.documents for r in hist.collect()} == Counter(n)
    for r in lengths.limits(hist).collect():
        c = r.context_limit
        assert (r.documents_over, r.tokens_over) == (sum(x > c for x in n), sum(x for x in n if x > c))
        assert (r.tokens_kept, r.tokens_lost) == (sum(min(x, c) for x in n), sum(x - min(x, c) for x in n))
        assert (r.documents_total, r.tokens_total) == (len(n), sum(n)) and r.quantile == pytest.approx(sum(x <= c for x in n) / len(n))
    asked = {r.context_limit: (r.documents_over, r.tokens_kept) for r in lengths.at_limits(hist, [0, 7, 100, 10**6]).collect()}
    assert asked == {c: (sum(x > c for x in n), sum(min(x, c) for x in n)) for c in (0, 7, 100, 10**6)}
    assert lengths.limits(lengths.histogram(none, BYTE)).collect() == []


# --- 4 paragraphs ---------------------------------------------------------------------


def plain_paragraphs(text):
    """(number, words) by reading the text line by line, sentence by sentence."""
    found = []
    for line in (text or "").split("\n"):
        sentences, here = [], []
        for w in re.findall("[^\x20\x09-\x0d]+", line):
            here.append(w)
            if w[-1] in ".!?":
                sentences.append(here)
                here = []
        sentences += [here] if here else []
        for k, s in enumerate(sentences):
            if k == 0 or len(s) >= 8:
                found.append([])
            found[-1] += s
    return [(k, [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in p]) for k, p in enumerate(found)]


def test_paragraph_clusters(docs, rows, none):
    where = [(r.doc_id, r.text, k, p) for r in rows for k, p in plain_paragraphs(r.text) if len(p) >= 8]
    sets = [{tuple(p[i : i + 5]) for i in range(len(p) - 4)} for *_, p in where]
    group = list(range(len(where)))
    for a, b in itertools.combinations(range(len(where)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    size = Counter(group)
    wanted = Counter((d, k, len(p), size[g]) for (d, _, k, p), g in zip(where, group, strict=True) if size[g] > 1 and len(p) >= 20)
    got = paragraphs.repeated(docs).collect()
    assert Counter((r.doc_id, r.paragraph, r.words, r.cluster_size) for r in got) == wanted
    texts = {r.doc_id: r.text for r in rows}
    for r in got:
        if r.doc_id is not None:
            assert len(texts[r.doc_id][r.start : r.start + r.length].split()) == r.words
    assert {60, 61, 62} <= {r.doc_id for r in got if r.removed}  # a passage inside a line
    assert paragraphs.repeated(none).collect() == []
    shorter = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    assert shorter[5] == texts[5] and shorter[20].strip() == "" and shorter[61] != texts[61]


def test_short_repeats_are_reported(spark):
    rng = random.Random(12)
    line = lambda n: " ".join(f"s{rng.randint(0, 10**6)}" for _ in range(n))
    alone, wrapped, mixed = line(9), [line(7) for _ in range(6)], [line(n) for n in (12, 3, 11, 1, 6)]
    texts = ["\n".join([line(30), *part, line(25)]) for part in ([alone], wrapped, mixed) for _ in range(3)] + [line(2)] * 2
    docs = spark.createDataFrame([*enumerate(texts), (10, texts[10])], "doc_id long, text string")
    got = Counter((r.doc_id, r.paragraph, r.words, r.cluster_size, r.run_words, r.removed) for r in paragraphs.repeated(docs).collect())
    wanted = Counter((d, 1, 9, 3, 9, d > 0) for d in range(3))
    wanted += Counter((d, k, 7, 3, 42, d > 3) for d in range(3, 6) for k in range(1, 7))
    wanted += Counter((d, k, n, 3, 33, d > 6) for d in range(6, 9) for k, n in enumerate((12, 3, 11, 1, 6), 1))
    assert got == wanted + Counter({(9, 0, 2, 3, 2, False): 1, (10, 0, 2, 3, 2, True): 2})
    shorter = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    assert [shorter[d] == texts[d] for d in range(10)] == [True] * 4 + [False] * 2 + [True] + [False] * 2 + [True]


def test_passages_inside_lines_are_reported(spark):
    rng = random.Random(13)
    line = lambda n: " ".join(f"é{rng.randint(0, 10**6)}" for _ in range(n))
    plain, short, quoted = line(60), " ".join(line(5) + "." for _ in range(12)), '"' + line(59) + '."'
    edited = line(200).split()
    copies = [list(edited), list(edited)]
    for k in range(45, 200, 45):
        copies[1][k] = "new"
    texts = [f"{line(20)} {p} {line(20)}" for p in (plain, short, quoted) for _ in range(3)]
    texts += [f"{line(90)} {' '.join(c)} {line(90)}" for c in copies] + [" ".join(["same"] * 30)]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[0])], "doc_id long, text string")
    rows = paragraphs.repeated(docs).collect()
    spans = defaultdict(list)
    for r in rows:
        if r.doc_id is not None:
            assert len(texts[r.doc_id][r.start : r.start + r.length].split()) == r.words
            spans[r.doc_id].append((r.start, r.start + r.length, r.removed))
    assert all(a[1] <= b[0] for s in spans.values() for a, b in itertools.pairwise(sorted(s)))
    for d in range(1, 9):  # text 0 is repeated whole
        shared = [plain, short, quoted][d // 3]
        low = texts[d].index(shared)
        assert 20 <= sum(r.words for r in rows if r.doc_id == d) <= 60
        assert all(low <= a and b <= low + len(shared) + 1 for a, b, _ in spans[d])
        assert {r for *_, r in spans[d]} == {d not in (3, 6)}
    assert sum(r.words for r in rows if r.doc_id == 10) >= 4 * 20 and 11 not in spans
    shorter = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    assert shorter[3] == texts[3] and len(shorter[4].split()) <= 80 and len(shorter[2].split()) <= 80


def test_similarity_by_blocks(spark):
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 30, 20).astype(np.uint64)) for _ in range(60)]
    plain = [[len(np.intersect1d(a, b)) >= 0.5 * len(np.union1d(a, b)) - 1e-9 for b in sets] for a in sets]
    assert (paragraphs.similar(sets, 0.5) == np.array(plain)).all()


# --- 8 decontamination -------------------------------------------------------------------


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = rng.integers(1, 6, rng.integers(1, 15)), rng.integers(1, 6, rng.integers(1, 25))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontaminate.align(a, b)[0] == h.max()


@pytest.mark.parametrize("block_words", [1_000_000, 30])
def test_leaks(spark, docs, none, block_words):
    rng = random.Random(8)
    items = [" ".join(f"b{rng.randint(0, 300)}" for _ in range(rng.randint(15, 50))) for _ in range(20)]
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "b1 b2"), (None, items[0])], "item_id long, text string")
    planted = []
    for i, t in enumerate(items):
        w = t.split()
        for k in range(4, len(w), 6):  # every sixth word edited
            w[k] = "edited"
        planted.append((1000 + i, "before it stands this " + (t.upper() if i % 2 else " ".join(w)) + ", and this after."))
    part = spark.createDataFrame([(1100, " ".join(items[0].split()[:5]))], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string")).unionByName(part)
    got = decontaminate.leaks(both, bench, block_words=block_words).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1000 + i, i) for i in range(20)}
    assert all(r.score == 1 for r in got if r.item_id % 2)
    kept = decontaminate.clean_documents(both, bench)
    assert kept.columns == both.columns and kept.count() == docs.count() + 1
    assert decontaminate.leaks(none, bench).collect() == [] and decontaminate.leaks(docs, bench.limit(0)).collect() == []


def test_every_alignment_over_the_limit_is_a_leak(spark):
    rng = random.Random(9)
    items = [" ".join(f"c{30 * i + k % 30 if i % 2 else 100 * i + k}" for k in range(n)) for i, n in enumerate([40, 40, 23, 60, 6, 5, 3, 17])]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    texts = [" ".join(f"n{rng.randint(0, 50)}" for _ in range(30)) for _ in range(5)]
    for t in items:
        for step in range(2, 9):
            w = t.split()
            texts.append(" ".join(["x", *("new" if k % step == step - 1 else x for k, x in enumerate(w)), "y"]))  # replaced
            texts.append(" ".join(x + (" new" if k % step == step - 1 else "") for k, x in enumerate(w)))  # added
            texts.append(" ".join(x for k, x in enumerate(w) if k % step != step - 1))  # left out
    w = items[0].split()
    texts += [" ".join("new" if k % 4 == 3 else x for k, x in enumerate(w))] * 60  # a large group of one edited copy
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    ids = {}
    number = lambda t: np.array([ids.setdefault(x, len(ids)) for x in t.split()])
    share = {(d, i): decontaminate.align(number(t), number(x))[0] / 2 / len(t.split()) for d, x in enumerate(texts) for i, t in enumerate(items)}
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {k: s for k, s in share.items() if s >= 0.6}


# --- 5 toxicity, 10 quality -----------------------------------------------------------------


@pytest.mark.parametrize("name,label,least", [("op10_ftrl_quality", "quality", 0.97), ("op5_counterfactual_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    sf_dir = "/root/testdata/sf0.1"
    got = queries.QUERIES[name](spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.predicted == r[label] for r in got) / len(got) >= least


def test_models_stand_awkward_rows(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 1), (None, 1, 1), (3, None, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    for learn, score in ((quality.learn_quality, quality.with_quality), (toxicity.learn_toxicity, toxicity.with_toxicity)):
        for given in (labels, labels.limit(0)):
            scored, name = score(docs, learn(docs, given))
            assert name == "score_" and scored.count() == docs.count()
            assert all(0 <= r[name] <= 1 for r in scored.collect())
        assert score(none, learn(none, labels))[0].collect() == []


def test_swapping_a_group_hardly_moves_a_score():
    rng = random.Random(6)
    words = [f"x{k}" for k in range(60)]
    text = lambda *more: " ".join([*(rng.choice(words) for _ in range(15)), *more])
    rows = [(text("scum", "muslim"), 1) for _ in range(60)] + [(text("scum"), 1) for _ in range(15)]
    rows += [(text("christian"), 0) for _ in range(60)] + [(text(), 0) for _ in range(60)]
    gap = {}
    for penalty in (0.0, 1.0):
        model = toxicity.fit([(toxicity.with_swaps(t), y, i) for i, (t, y) in enumerate(rows)], penalty=penalty)
        weights = toxicity.dense(model, toxicity.SIZE)
        score = lambda t: toxicity.sigmoid(float(weights[toxicity.presence(t)[0]].sum()))  # noqa: B023, E731
        gap[penalty] = score("x1 x2 muslim") - score("x1 x2 christian")
        assert score("x1 x2 scum") > 0.5
    assert abs(gap[1.0]) < 0.1 < gap[0.0] and score("x1 x2 muslim") < 0.5


# --- pipeline ----------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir).cache()
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count(), name
        docs = kept
    assert docs.count() < before
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_on_awkward_rows(spark, docs, sf_dir):
    kept = docs
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, sf_dir)
    assert kept.count() > 0
