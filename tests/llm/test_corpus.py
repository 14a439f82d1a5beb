"""The ten operators against brute force, round trips and held-out accuracy,
with nulls, empty and long texts, ties, repeated rows, empty tables and clashing
column names."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from rivulet.llm import chat, components, embeddings, language, lines, media, mixing, packing, quality, queries, sharding, simhash
from rivulet.llm.scratch import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta river stone cloud green seven eight night ocean paper light train".split()


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [(i, prose(rng, rng.randrange(1, 120)), "en", f"s{i % 3}", 0) for i in range(40)]
    out += [(100, None, None, None, None), (101, "", "en", "s0", 0), (102, " \n\t ", "en", None, 0), (103, "12 34 !!", "en", "s1", 0), (104, "one two", "en", "s1", 0)]
    out += [(200 + i, out[5][1], "en", "s2", 0) for i in range(80)]  # exact copies
    out += [(300, prose(rng, 9000), "en", "s0", 0), (301, "é ß 日本 " * 50, "fr", "s1", 0), (5, out[5][1], "en", "s2", 0), (None, "null id", "en", "s1", 0)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3, F.xxhash64("doc_id", "text")).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def roots(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, 5000)]
    got = components.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"))
    assert {r.node: r.component for r in got.collect()} == roots([e for e in edges if e[0] != e[1]])
    assert components.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def test_language(spark, docs, none, sf):
    held = queries.op1_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "n_chars"), "doc_id").where("held_out and n_chars > 100")
    hits = [r.lang == r.lang_pred for r in held.collect()]
    assert len(hits) > 10 and np.mean(hits) > 0.9
    learned = language.learn(docs)
    assert set(learned) <= {"en", "fr"} and language.learn(none) == {}
    got = language.identify(docs.withColumn("score", F.lit("clash")).drop("score"), learned).collect()
    assert all((r.lang_pred == "und") == (not r.text or not any(c.isalpha() for c in r.text)) for r in got) and all(0 <= r.score <= 1 for r in got)
    assert language.identify(docs, {}).where("lang_pred <> 'und' or not rejected").count() == 0
    assert language.identify(none, learned).count() == 0
    assert docs.select("doc_id", language.fold().alias("f")).where("doc_id = 7").first().f == zlib.crc32(b"7") % 5


def test_language_learns_every_label(spark):
    rows = [(f"l{i:02}", f"alpha{k} beta gamma {chr(97 + i % 26) * 4}") for i in range(70) for k in range(1 + i % 2)]
    learned = language.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert set(learned) == {x for x, _ in rows} and all(learned.values())


def test_mixing(spark, docs, none, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for _, t, _, s, _ in rows:
        size[s] += len((t or "").encode().split())
    aims = mixing.targets(list(size.items()))
    assert sum(aims.values()) == pytest.approx(sum(size.values()))
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == size[r.source] and r.target == pytest.approx(aims[r.source]) and (not r.size or r.taken % r.size == 0)
        taken[r.source] += r.taken
    for s in size:  # s0 is nearly one document of 9000 words
        assert 0 <= aims[s] - taken[s] <= (9000 if s == "s0" else 0.02 * aims[s] + 1)
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, got))
    assert mixing.mix(none).count() == 0


def test_targets_and_fit():
    assert mixing.targets([("b", 10), ("a", 80), (None, 10)]) == {"a": pytest.approx(40.0), "b": 30.0, None: 30.0}
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0.0}
    rng = random.Random(2)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 60), rng.randrange(1, 12)))
        counts = [rng.randrange(1, 30) for _ in lengths]
        total = sum(a * b for a, b in zip(lengths, counts))
        budget = rng.randrange(total + 1)
        take = mixing.fit(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts))
        assert 0 <= budget - sum(t * n for t, n in zip(take, lengths)) < max(lengths)


def test_quality(spark, docs, none, sf):
    got = quality.quality(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("y")), "doc_id").collect()
    good, bad = ([r.quality for r in got if r.y == y] for y in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.85
    same = quality.quality(docs).groupBy("text").agg(F.countDistinct("quality").alias("n"))
    assert same.where("n > 1").count() == 0
    assert quality.quality(docs).where("text is null and votes = '000000'").count() == 1
    assert quality.quality(none).count() == 0


def test_sharding(spark, docs):
    names = sharding.shard_names(5)
    table = sharding.fill(names, 251)
    counts = collections.Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill(names[:-1], 251)
    assert np.mean([names[a] != names[b] for a, b in zip(table, fewer)]) < 0.45
    got = sharding.place(docs.withColumn("shard", F.lit("clash")), "doc_id", names, 251).collect()
    assert len(got) == docs.count()
    for r in got:
        want = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16) % 251
        assert (r.slot, r.shard) == (want, names[table[want]])
    for bad in (([], 7), (["a"], 8), (["a", "a"], 7)):
        with pytest.raises(ValueError):
            sharding.fill(*bad)


def test_packing(spark, docs, none, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    got = packing.pack(docs, path).collect()
    whole, used = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        whole[r.doc_id].append((r.start, ids, r.doc_tokens))
        used[r.sequence_id].append((r.offset, r.length))
    texts = collections.defaultdict(list)
    for d, t, *_ in rows:
        texts[d].append(t)
    for d, ts in texts.items():
        want = plain.encode(ts[0] or "", add_special_tokens=False).ids + [1]
        assert sum(len(i) for _, i, _ in whole[d]) == len(want) * len(ts) and {n for _, _, n in whole[d]} == {len(want)}
        assert all(ids == want[s : s + len(ids)] for s, ids, _ in whole[d])
    for parts in used.values():
        parts.sort()
        assert all(o == sum(n for _, n in parts[:i]) for i, (o, _) in enumerate(parts)) and sum(n for _, n in parts) <= 2048
    assert sum(sum(n for _, n in p) < 2048 for p in used.values()) <= 1
    assert packing.pack(none, path).count() == 0


def test_encoder_equals_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = packing.encoder(path)
    rng, pieces = random.Random(3), [*"aZ.,!'sÉé ß\n\t\r 1٣Σσ!İ<|>_-​", "'s", "...", "<|endoftext|>", "ll", "ABC", "\x1c", "e\u0301"]
    for _ in range(3000):
        t = "".join(rng.choices(pieces, k=rng.randrange(14)))
        assert encode(t).tolist() == encode.tokenizer.encode(t, add_special_tokens=False).ids + [1], t


def test_media_round_trip(spark, docs, none):
    rng = np.random.default_rng(1)
    for n in (1, 3, 8, 9, 40):
        payload = rng.integers(0, 256, n * 192, dtype=np.uint8).tobytes()  # with 0xFF, the general decoder
        assert media.clips_of(media.write_avi(payload))[0] == payload
    frames = [np.full((4, 192), v, np.uint8) for v in [40] * 12 + [220] * 12]
    payload = b"".join(f.tobytes() for f in frames)
    _, clips = media.clips_of(media.write_avi(payload, 4))
    assert [(c[0], c[1], c[2]) for c in clips] == [(0, 12, 0.0), (12, 12, 0.48)]
    assert sorted(media.ZIGZAG[:6].tolist()) == [0, 1, 2, 8, 9, 16] and media.ZIGZAG[:6].tolist() == [0, 1, 8, 16, 9, 2]
    got = media.media_digests(docs).collect()
    by = collections.defaultdict(set)
    for r, t in zip(got, [r.text for r in docs.select("text").collect()]):
        raw = (t or "").encode()
        full = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]))
        by[t].add((r.media_sha256, str(r.clips)))
    assert all(len(v) == 1 for v in by.values())
    stored = media.with_clips(media.with_media(docs.where("doc_id in (1, 100)")))
    assert media.clip_rows(stored, "doc_id").count() >= 2
    assert media.media_digests(none).count() == 0
    with pytest.raises(ValueError):
        media.read_avi(b"nothing")


def brute_fingerprint(t, size=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    if not w:
        return 0
    s = [b" ".join(w)] if len(w) < size else [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    v = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return v - (1 << 64) if v >> 63 else v


def test_simhash(spark, docs, none, rows):
    got = simhash.simhash_components(docs).collect()
    prints = {t: brute_fingerprint(t) for _, t, *_ in rows}
    ids = collections.defaultdict(set)
    for d, t, *_ in rows:
        ids[prints[t]].add(d)
    edges = [(a, b) for a in ids for b in ids if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    comp = roots(edges)
    low = collections.defaultdict(list)
    for f, c in comp.items():
        low[c] += [d for d in ids[f] if d is not None]
    assert len(got) == len(rows)
    want = collections.Counter((d, prints[t], min(low[comp[prints[t]]], default=None)) for d, t, *_ in rows)
    assert collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert simhash.simhash_components(none).count() == 0


def test_dense_fingerprints(spark):
    """Keys over the pairwise size take the linear way and lose no link."""
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(50)}
    base = rng.getrandbits(64)
    for _ in range(400):
        prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 7))))
    prints = [p - (1 << 64) if p >> 63 else p for p in prints]
    s = Scratch(spark, "t")
    found = components.components(simhash.linked(spark.createDataFrame([(p,) for p in prints], "fingerprint long"), s), s)
    want = roots([(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2])
    assert {r.node: r.component for r in found.collect()} == want


def test_near_duplicates(spark, none):
    rng = random.Random(8)
    rows, truth = [], set()
    for g in range(12):
        words = [f"{rng.choice(WORDS)}{rng.randrange(999)}" for _ in range(200)]
        rows.append((g * 100, " ".join(words)))
        for k in range(1, 30 if g == 0 else 3):
            w = list(words)
            for i in rng.sample(range(200), 2):
                w[i] = f"new{rng.randrange(10**6)}"
            rows.append((g * 100 + k, " ".join(w)))
            truth.add((g * 100 + k, g * 100))
    rows += [(9000 + i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(80))) for i in range(20)] + [(9100, None), (9101, " ")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "key long, text string"), "key")
    found = {(r.key, r.group) for r in got.collect() if r.key != r.group}
    assert found == truth
    assert simhash.near_duplicates(none.select(F.col("doc_id").alias("key"), "text"), "key").count() == 0


def test_near_duplicates_are_by_jaccard(spark):
    """Groups against exact components, of pairs from 0.75 to 0.87 and of short texts."""
    rng = random.Random(21)
    word = lambda: f"{rng.choice(WORDS)}{rng.randrange(10**6)}"
    sets, rows = {}, []
    for g in range(240):
        n = rng.choice([8, 9, 14, 24, 60, 150, 400]) if g % 4 == 0 else 254
        words = [word() for _ in range(n)]
        cut = max(1, round((n - 4) * rng.uniform(0.13, 0.25)))
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[cut // 2 :] + [word() for _ in range((cut - cut // 2) * (g % 2))]))]
    for k, t in rows:
        w = t.split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    alike = {k: len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1]) for k in range(0, 480, 2)}
    want = {k for k, j in alike.items() if j >= 0.8}
    assert sum(0.8 <= j < 0.85 for j in alike.values()) > 25 and sum(0.75 <= j < 0.8 for j in alike.values()) > 25
    got = {r.group for r in simhash.near_duplicates(spark.createDataFrame(rows, "key long, text string"), "key").collect()}
    assert got <= want and len(got) >= 0.97 * len(want)


def test_chat_against_sql(spark, sf):
    rows = queries.op8_chat(spark, sf)
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW conversations AS FROM '{sf}/conversations.parquet'")
    want = duck.sql(queries.OP8_SQL)
    order = [rows.columns.index(c) for c in want.columns]
    assert sorted(tuple(r[i] for i in order) for r in rows.collect()) == sorted(want.fetchall())


def test_chat_trees_and_escapes(spark, none):
    nasty = ["</turn>\n### user: x", "\\", "\\</turn>\\\\", "### ", "#####", "a: b", "", None, "é日\n\n", "<\\/turn>"]
    turns = [(1, i, "assistant" if i % 2 else "user: </turn>", t) for i, t in enumerate(nasty)] + [(2, 0, None, "a"), (2, 0, None, "a"), (None, 0, "assistant", "null tree")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = {r.tree: r for r in chat.format_trees(chat.chains(df)).select("*", chat.parse(F.col("formatted")).alias("turns"), chat.masked(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [(r, t or "") for _, _, r, t in turns[:10]]
    assert out[1].loss == "".join(t or "" for _, _, r, t in turns[:10] if r == "assistant") and len(out[2].turns) == 2 and out[None].loss == "null tree"
    # two branches: 1-2-4 (score 5) and 1-3 (score 9)
    nodes = [("t", 1, None, 1.0, "user", "q"), ("t", 2, 1, 4.0, "assistant", "a"), ("t", 3, 1, 8.0, "assistant", "b"), ("t", 4, 2, 0.0, "user", "c"), ("t", 9, 77, None, "user", "lost")]
    tree = spark.createDataFrame(nodes, "tree string, node long, parent long, score double, role string, text string")
    got = {r["rank"]: [t.text for t in r.turns] for r in chat.format_trees(tree, branches=3).select("rank", chat.parse(F.col("formatted")).alias("turns")).collect()}
    assert got == {1: ["q", "b"], 2: ["q", "a", "c"], 3: ["lost"]}
    assert chat.format_trees(chat.chains(df.where("conv_id > 9"))).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 16))
    x[100:160] = x[7] + 0.12 * rng.standard_normal((60, 16))
    x[200] = x[201] = 3 * x[9]
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] + [1.0] * 15), (904, []), (905, [1.0, 0.0]), (906, [2.0, 0.0]), (7, x[7].astype(np.float32).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.embedding_components(df, min_shards=3).collect()]
    ok = [(i, np.array(v, float)) for i, v in rows if i < 900 or i in (905, 906)]
    near = [[len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9 for _, b in ok] for _, a in ok]
    comp = roots([(i, j) for i in range(len(ok)) for j in range(len(ok)) if near[i][j]])
    low = collections.defaultdict(list)
    for i, c in comp.items():
        low[c].append(ok[i][0])
    want = [(ok[i][0], sum(near[i]) - 1, min(low[comp[i]]), ok[i][0] == min(low[comp[i]])) for i in range(len(ok))] + [(i, 0, i, True) for i in (900, 901, 902, 903, 904)]
    assert sorted(got) == sorted(want)
    assert embeddings.embedding_components(df.limit(0)).count() == 0


def test_audit_counts_each_probe():
    """Small groups that the graph does not reach are found beside a hot group."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1800, 24))
    x[:1200] = x[0] + 0.05 * rng.standard_normal((1200, 24))
    x[1201::2] = x[1200::2] + 0.1 * rng.standard_normal((300, 24))
    u = embeddings.unit(x)
    hot = embeddings.build(u[:1200].astype(np.float32))
    layers = [np.concatenate([m, np.full((600, m.shape[1]), -1)]) for m in hot.layers]
    graph, ids = embeddings.Graph(u.astype(np.float32), layers, hot.entry), np.arange(1800)
    links, edges = embeddings.query_block(graph, x, ids, np.ones(1800, np.int64), x, ids, 0.9)
    assert links.tolist() == ((u @ u.T >= 0.9).sum(axis=1) - 1).tolist()
    assert {(a, b) for a, b in edges.tolist() if a >= 1200} >= {(i + 1, i) for i in range(1200, 1800, 2)}


def test_embeddings_small_rows(spark, monkeypatch):
    """No task needs a shard at once: every row of every table is a vector and its
    cells at most, also with a third of the rows in one group, which is compared
    by fragments, in several slices."""
    monkeypatch.setattr(embeddings, "FRAGMENT", 300, raising=False)
    monkeypatch.setattr(embeddings, "SLICE", 1 << 10, raising=False)
    widest, cut = [], Scratch.cut

    def seen(self, df, label="t"):
        out = cut(self, df, label)
        widest.extend(out.agg(F.max(F.length(c))).first()[0] or 0 for c, kind in out.dtypes if kind == "binary")
        return out

    monkeypatch.setattr(Scratch, "cut", seen)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((2400, 32))
    x[:800] = x[0] + 0.2 * rng.standard_normal((800, 32))
    x[801:1600:2] = x[800:1600:2] + 0.15 * rng.standard_normal((400, 32))
    x = rng.permutation(x).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.embedding_components(df, min_shards=24).collect()}
    u = embeddings.unit(x.astype(np.float64))
    near = u @ u.T >= 0.9
    comp = roots(np.argwhere(near).tolist())
    low = {c: min(i for i in comp if comp[i] == c) for c in set(comp.values())}
    assert got == {i: (int(near[i].sum()) - 1, low[comp[i]]) for i in range(len(x))}
    assert max(widest) <= 8 * x.shape[1]


def test_embeddings_large_group(monkeypatch):
    """A third of the rows link with one another, far beyond a beam of DENSE."""
    monkeypatch.setattr(embeddings, "STEP", 10_000)
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(32)
    x = rng.permutation(np.concatenate([centre + 0.2 * rng.standard_normal((1100, 32)), rng.standard_normal((2200, 32))]))
    u = embeddings.unit(x)
    ids, copies = np.arange(3300) * 3 + 1, rng.integers(1, 4, 3300)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    assert near.sum(axis=1).max() > 2 * embeddings.DENSE
    graph = embeddings.build(u.astype(np.float32))
    some = np.arange(0, 3300, 7)
    links, edges = embeddings.query_block(graph, x, ids, copies, x[some], ids[some], 0.9)
    assert links.tolist() == (near[some] @ copies).tolist()
    root = {int(i): int(i) for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges.tolist():
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    for k in some:  # every link of a query lies within one component
        assert {find(int(i)) for i in ids[near[k]]} <= {find(int(ids[k]))}
    assert len(edges) < 2 * len(ids)  # spanning edges, not links
    loners = ids[~near.any(axis=1)]
    assert all(find(int(i)) == i for i in loners)


def test_lines(spark, docs, none, rows):
    rng = random.Random(6)
    line = lambda n=12: " ".join(f"{rng.choice(WORDS)}{rng.randrange(10**6)}" for _ in range(n))
    passage, common = [line() for _ in range(5)], "all rights reserved"
    own = lambda k: [line() for _ in range(k)]
    texts = [own(3) + passage + own(2), own(1) + [common] + own(1)] + [own(2) + passage + [common] + own(1) for _ in range(12)]
    df = spark.createDataFrame([(i, "\n".join(t), "kept") for i, t in enumerate(texts)] + [(50, "\n".join(texts[0]), "copy"), (None, "\n".join(passage), "null")], "doc_id long, text string, removed string")
    got = {r.doc_id: r for r in lines.line_dedup(df).collect()}
    assert got[0].text == "\n".join(texts[0]) and got[1].text == "\n".join(texts[1]) and got[None].text == "\n".join(passage)
    for i in range(2, 14):
        assert not set(passage) & set(got[i].text.split("\n")) and set(texts[i]) - set(passage) - {common} <= set(got[i].text.split("\n"))
    assert got[50].text == "" and [tuple(b) for b in got[50].removed] == [(0, 9)]
    assert lines.patience([1, 2, 3, 4], [9, 2, 3, 8, 4]) == [(1, 1), (2, 2), (3, 4)]
    assert lines.patience([], [1]) == [] and lines.patience([7, 7], [7, 7, 7]) == [(0, 0), (1, 1)]
    same = {(r.doc_id, r.text): r for r in lines.line_dedup(docs).collect()}
    assert len([r for r in same]) > 0 and lines.line_dedup(docs).count() == len(rows) and lines.line_dedup(none).count() == 0


def deleted_by_all_pairs(texts, min_words=20):
    """{id: line numbers} of the blocks that aligning every pair of documents finds."""
    split = {i: [x.strip(" \t\r\x0b\x0c") for x in t.split("\n")] for i, t in texts.items()}
    number = {x: k for k, x in enumerate(sorted({x for v in split.values() for x in v} | {""}))}
    held = {i: [number[x] for x in v] for i, v in split.items()}
    out = collections.defaultdict(set)
    for b in held:
        words = [x.count(" ") + 1 if x else 0 for x in split[b]]
        for a in held:
            if a < b and sum(w for x, w in zip(held[b], words) if x in held[a]) >= min_words:
                for first, last in lines.common_blocks(held[b], words, held[a], min_words):
                    out[b].update(range(first, last + 1))
    return out


def lines_removed(df):
    got = lines.line_dedup(df).where("removed is not null").collect()
    for r in got:
        assert all(x["last"] + 1 < y["first"] for x, y in zip(r.removed, r.removed[1:]))
    return {r.doc_id: {x for b in r.removed for x in range(b["first"], b["last"] + 1)} for r in got}


def test_lines_against_all_pairs(spark, sf):
    """Blocks of frequent lines whose first holders differ, crossing and recurring blocks, blank lines."""
    rng = random.Random(12)
    line = lambda n: " ".join(f"{rng.choice(WORDS)}{rng.randrange(10**6)}" for _ in range(n))
    common = [line(n) for n in (3, 5, 7, 9, 11, 21, 1, 2)]
    texts = {i: f"{c}\n{line(3)}" for i, c in enumerate(common)}  # each line's first holder
    texts |= {20 + i: "\n".join(rng.choices(common[2:5], k=2) + [line(4)]) for i in range(10)}
    block = "\n".join([common[1], common[3], "", common[4], ""])  # 25 words of lines over 8 documents hold
    texts |= {40 + i: f"{line(2)}\n{block}\n{line(3)}" for i in range(12)}
    for i in range(100, 220):
        parts = [rng.choice([rng.choice(common), "", line(2), "\n".join(common[1:4]), "\n".join(common[3:6])]) for _ in range(rng.randrange(1, 9))]
        texts[i] = "\n".join(parts)
    texts |= {300 + i: texts[i] for i in (40, 101, 102, 103)}
    want = deleted_by_all_pairs(texts)
    assert all(want[41 + i] >= {1, 2, 3, 4} for i in range(11))
    assert lines_removed(spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(3)) == want
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("doc_id is not null and text is not null")
    unique = table.groupBy("doc_id").agg(F.min("text").alias("text"))
    assert lines_removed(unique) == deleted_by_all_pairs({r.doc_id: r.text for r in unique.collect()})


def test_pipeline(spark, sf, tmp_path):
    d, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d, sf).write.parquet(str(tmp_path / str(k)))
        d = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(d.count())
        if k < 4:
            assert d.columns == corpus_pipeline.COLUMNS, name
    assert kept[0] > 150 and kept[2] <= kept[1] <= kept[0]
    assert kept[4] == corpus_pipeline.run(spark, sf).count()
