"""Brute-force versions of language, mixing and quality; clashing names, repeated
rows, long texts, empty tables; the pipeline stage by stage."""

import collections
import hashlib
import itertools
import random

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from rivulet.llm import chat, embeddings, language, media, mixing, quality, sharding, simhash
from rivulet.llm.scratch import Scratch, shared_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta river stone cloud green seven eight night ocean paper light train".split()
FREMD = "strasse wasser himmel garten sieben nacht papier licht bruder schwester abend morgen winter".split()


def prose(rng, n, words=WORDS):
    return " ".join(rng.choices(words, k=n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(20, 90), FREMD if i % 3 == 0 else WORDS) + f" w{i}.", "de" if i % 3 == 0 else "en", f"s{i % 4}", 0) for i in range(120)]
    rows += [(500, None, None, None, None), (501, "", "en", "s0", 0), (None, rows[7][1], "en", "s1", 0), (7, rows[8][1], "en", "s3", 0), rows[9], rows[9], (None, None, None, None, None)]
    rows += [(600, prose(rng, 90_000), "en", "s0", 0), (601, "12 !! 34", "en", "s1", 0)]
    return spark.createDataFrame(rows, DOCS)


def test_language_against_plain_compression(docs):
    learned = language.learn(docs)
    clash = docs.withColumn("score", F.lit("mine")).withColumn("Rejected", F.lit("mine")).withColumn("lang_pred", F.lit("mine"))
    got = language.identify(clash, learned)
    assert got.columns == [*docs.columns, "lang_pred", "score", "rejected"]
    for r in got.collect():
        said = language.letters(r.text)
        if not said:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        sizes = {}
        for k in sorted(learned):
            d = zstandard.ZstdCompressionDict(learned[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[k] = sum(len(c.compress(said[i : i + language.BLOCK].encode())) for i in range(0, len(said), language.BLOCK))
        first, second = sorted(sizes.values())
        assert r.lang_pred == min(sizes, key=lambda k: (sizes[k], k)) and r.score == pytest.approx(1 - first / second) and r.rejected == (r.score < 0.02)
    plan = language.identify(docs, learned).where("not rejected")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_fit_against_all_sums():
    rng = random.Random(3)
    for _ in range(60):
        lengths = sorted(rng.sample(range(5, 400), rng.randrange(1, 5)))
        counts = [rng.randrange(1, 4) for _ in lengths]
        budget = rng.randrange(1, sum(a * b for a, b in zip(lengths, counts)) + 1)
        base = [c * budget // sum(a * b for a, b in zip(lengths, counts)) for c in counts]
        best = max(s for pick in itertools.product(*(range(b, c + 1) for b, c in zip(base, counts))) if (s := sum(n * k for n, k in zip(lengths, pick))) <= budget)
        assert sum(n * k for n, k in zip(lengths, mixing.fit(lengths, counts, budget))) == best
    assert mixing.fit([17_000, 17_001, 20_000], [1, 1, 1], 34_001) == [1, 1, 0]
    many = [2 * i for i in range(1, 3000)]  # far more lengths than any fixed number of items
    assert sum(n * k for n, k in zip(many, mixing.fit(many, [1] * len(many), 4_000_001))) == 4_000_000


def test_mixing_repeated_rows_and_stage(spark, docs):
    got = collections.Counter()
    for r in mixing.mix(docs).collect():
        got[r.source] += r.taken
    packed = corpus_pipeline.mix_sources(spark, docs, None).select("source", mixing.words().alias("n")).groupBy("source").agg(F.sum("n").alias("n"))
    assert {r.source: r.n for r in packed.collect()} == {s: n for s, n in got.items() if n}


def test_labellers_are_recovered():
    """Votes drawn with known chances: estimates come near them, far from the prior."""
    rng = np.random.default_rng(8)
    true = np.array([[[0.6, 0.4, 0.0], [0.5, 0.5, 0.0], [0.3, 0.5, 0.2], [0.2, 0.3, 0.5], [0.55, 0.25, 0.2], [0.4, 0.4, 0.2]], [[0.02, 0.98, 0.0], [0.01, 0.99, 0.0], [0.02, 0.38, 0.6], [0.05, 0.15, 0.8], [0.05, 0.25, 0.7], [0.03, 0.37, 0.6]]])
    n, truth = 200_000, rng.random(200_000) < 0.7
    votes = np.stack([np.where(truth, *(rng.choice(3, n, p=true[t, k]) for t in (1, 0))) - 1 for k in range(6)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, chance, post = quality.fit_labellers(patterns, counts.astype(float))
    assert abs(share - 0.7) < 0.05 and np.abs(chance - true).max() < 0.06
    exact = 0.7 * np.prod([true[1, k][patterns[:, k] + 1] for k in range(6)], axis=0)
    other = 0.3 * np.prod([true[0, k][patterns[:, k] + 1] for k in range(6)], axis=0)
    assert np.average(np.abs(post - exact / (exact + other)), weights=counts) < 0.03


def test_quality_edges(spark, docs):
    clash = docs.withColumn("quality", F.lit("mine")).withColumn("Votes", F.lit("mine")).withColumn("posterior", F.lit("mine"))
    got = quality.quality(clash)
    assert got.columns == [*docs.columns, "votes", "posterior", "quality"]
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.quality <= 1 for r in rows)
    same = collections.defaultdict(set)
    for r in rows:
        same[r.text].add((r.votes, r.quality))
    assert all(len(v) == 1 for v in same.values())


def test_sharding_by_hand(spark, docs):
    names, size, taken = sharding.shard_names(4), 53, {}
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    wishes = [[(number(n + "/offset") + j * (number(n + "/skip") % (size - 1) + 1)) % size for j in range(size)] for n in names]
    while len(taken) < size:
        turn = len(taken) % 4
        taken[next(s for s in wishes[turn] if s not in taken)] = turn
    assert [taken[s] for s in range(size)] == list(sharding.fill(names, size))
    assert sharding.place(docs.limit(0), "doc_id", names, size).count() == 0


def test_fingerprint_of_long_texts():
    rng = random.Random(2)
    text = prose(rng, simhash.CHUNK + 700)
    whole = [h for part in simhash.shingle_hashes(text, 3) for h in part.tolist()]
    assert len(whole) == simhash.CHUNK + 698
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in whole) > len(whole))
    assert simhash.fingerprint(text) & (2**64 - 1) == want


def test_no_control_string_in_a_body(spark):
    nasty = ["#### Assistant: hi", "##### ", "### x", "a#", "#", "##", "###", "</turn></turn>", "\\#", "\\\\###", "x </turn>\n### user: y", "#\\##"]
    rows = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(nasty)], "conv_id long, turn long, role string, text string")
    bodies = [r.e for r in rows.orderBy("turn").select(chat.escape(F.col("text")).alias("e")).collect()]
    assert not any("### " in ("x" + b).replace("x", "", 1) or "</turn>" in b or "###" in b for b in bodies)
    out = chat.format_trees(chat.chains(rows))
    assert [t.text for t in out.select(chat.parse(F.col("formatted")).alias("t")).first().t] == nasty
    formatted = out.first().formatted
    assert formatted.count("### ") == len(nasty) == formatted.count("</turn>")


def test_vectors_of_any_size(spark):
    big, small = [1e300, 1e300], [1e-300, 1e-300]
    rows = [(1, big), (2, small), (3, [1.0, 1.0]), (4, [1e300, -1e300]), (5, [5e-324, 0.0]), (6, [3.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5)}


def test_near_duplicates_at_a_dense_cloud(spark):
    """Many rows just under the threshold, and links between two large groups."""
    rng = random.Random(31)
    word = lambda: f"{rng.choice(WORDS)}{rng.randrange(10**6)}"
    base = [word() for _ in range(150)]

    def changed(words, k):
        w = list(words)
        for i in rng.sample(range(len(w)), k):
            w[i] = word()
        return w

    texts = [changed(base, rng.choice([1, 2, 3, 4, 5, 6])) for _ in range(150)] + [changed(base, 30) for _ in range(20)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    sizes = collections.Counter(map(find, range(len(rows))))
    want = {i: find(i) for i in range(len(rows)) if sizes[find(i)] > 1}
    got = {r.key: r.group for r in simhash.near_duplicates(spark.createDataFrame(rows, "key long, text string"), "key").collect()}
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want)
    assert all(want[k] == want[g] for k, g in got.items())


def test_pipeline_edges(spark, docs, tmp_path):
    """Nulls, repeated ids, equal rows and further columns through all stages; empty tables."""
    d, none = docs.withColumn("h", F.lit("extra")).withColumn("times", F.lit("extra")), docs.limit(0)
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d if k else d.select(*docs.columns, "h", "times"), None).write.parquet(str(tmp_path / name))
        d = spark.read.parquet(str(tmp_path / name))
        kept.append(d.count())
        assert stage(spark, none, None).count() == 0, name
    assert 100 < kept[2] <= kept[1] <= kept[0] < docs.count()
    pieces = spark.read.parquet(str(tmp_path / "pack_sequences"))
    mixed = spark.read.parquet(str(tmp_path / "mix_sources"))
    want = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert {r.doc_id: r.n for r in pieces.where("start = 0").groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == want


def test_scratch(spark, tmp_path):
    assert shared_folder(spark)
    s = Scratch(spark, "t")
    a, b = s.cut(spark.range(3)), s.cut(spark.range(4))
    s.keep(b)
    assert b.count() == 4
    with pytest.raises(Exception):
        a.count()


def test_every_hard_cut_is_found():
    """Equal cuts near the start and close to one another; lasting noise is no cut."""
    flat = lambda v, n: np.full((n, 192), v, np.uint8)
    film = np.concatenate([flat(40, 1), flat(220, 3), flat(40, 2), flat(220, 3), flat(90, 9)])
    assert [(c[0], c[1]) for c in media.shots(film, 25)] == [(0, 1), (1, 3), (4, 2), (6, 3), (9, 9)]
    noise = np.concatenate([flat(40 if i % 2 else 220, 1) for i in range(40)])
    assert len(media.shots(noise, 25)) <= 3
    rng = np.random.default_rng(1)
    slow = rng.normal(120, 40, (60, 192)).clip(0, 255).astype(np.uint8)
    assert len(media.shots(slow, 25)) <= 4
    assert media.shots(flat(1, 1), 25) == [(0, 1, 0.0, 1 / 25, 0.0)]


def test_repeated_passages_are_seen():
    rng = random.Random(6)
    passage = " ".join(f"{rng.choice(WORDS)}{rng.randrange(900)}" for _ in range(450))
    assert quality.votes(" ".join([passage] * 8))[-1] == -1 and quality.votes(passage)[-1] == 0
    assert quality.votes(" ".join(f"{rng.choice(WORDS)}{rng.randrange(900)}" for _ in range(5000)))[-1] == 0
