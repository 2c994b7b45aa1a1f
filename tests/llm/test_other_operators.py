"""Near-duplicates, neighbours, lines, tokens, quality and toxicity against
plain Python versions, round trips and held-out labels."""

import random

import brute as B
import numpy as np
import pytest
from llm_data import DOCS, SF
from pyspark.sql import functions as F

from tessera.llm import components, line_dedup, neighbours, quality, simhash_dedup, token_output, toxicity
from tessera.llm.common import read


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# SimHash near-duplicates -------------------------------------------------

def test_groups_match_plain_version(spark, table):
    want = B.near_duplicates(table("documents", "doc_id, text"))
    got = simhash_dedup.group_documents(spark, SF).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_odd_documents(spark, clashing, no_docs):
    rows = [(r.doc_id, r.text) for r in clashing.collect()]
    got = simhash_dedup.near_duplicates(clashing).collect()
    key = lambda t: (t[0] is None, t[0] or 0, *t[1:2])
    assert sorted(((r.k_id, format(r.fp & (2**64 - 1), "016x"), r.component_id) for r in got), key=key) == sorted(B.near_duplicates(rows), key=key)
    assert simhash_dedup.near_duplicates(no_docs).isEmpty()


def test_fingerprint_of_spark_and_python_hash(spark):
    import xxhash

    assert spark.sql("SELECT xxhash64('one two three four')").first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest("one two three four", 42)


def test_masks_cover_every_pair():
    rng = random.Random(3)
    for level in (0, 1, 2):
        masks = simhash_dedup.covering_masks(4, level)
        assert len(masks) == 31 and all(20 < m.bit_count() < 45 for m in masks)
        for _ in range(5000):
            diff = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(m & diff == 0 for m in masks)


@pytest.mark.parametrize("bucket_rows", [4, 2048])
def test_links_of_dense_families(spark, bucket_rows):
    """Families of close fingerprints, with buckets above and below the limit."""
    rng = random.Random(5)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(60)}
    fps |= {0, 1, 2**63, 2**64 - 1, 15, 31}
    want = B.components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(3)
    got = {r.node: r.root for r in components.connected(simhash_dedup.links(nodes, 4, bucket_rows)).collect()}
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(signed(f))
    assert got == {f: min(g) for g in groups.values() if len(g) > 1 for f in g}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200)] + [(301, 300), (300, 301)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}


def test_one_document_of_each_group_stays(spark, clashing):
    out = simhash_dedup.representatives(clashing)
    assert out.columns == clashing.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 6, 7, 8]


def test_groups_of_repeated_and_missing_ids_keep_one_each(spark):
    rng = random.Random(8)
    text = lambda: [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    a, b, c = text(), text(), text()
    near = [" ".join(c), " ".join([*c, "end"]), " ".join(["start", *c])]
    fps = [B.fingerprint(t) for t in near]
    assert len(set(fps)) > 1 and all((fps[0] ^ f).bit_count() <= 4 for f in fps)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (1, " ".join(b)), (2, " ".join(b)), *[(None, t) for t in near]]
    out = [(r.doc_id, r.text) for r in simhash_dedup.representatives(docs_of(spark, rows)).collect()]
    assert len(out) == 3 and {(1, " ".join(a)), (1, " ".join(b))} < set(out)
    assert [t for i, t in out if i is None][0] in near


# neighbours --------------------------------------------------------------

VEC = "vec_id long, embedding array<float>, label int"


def run_nearest(spark, rows, **more):
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, VEC), F.col("vec_id") % 100 == 0, **more).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return got


def test_recall_and_distances(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 24)).astype(np.float32)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    want = B.nearest([(i, v) for i, v, _ in rows])
    got = run_nearest(spark, rows, block=128, share=0.3)
    hit = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want])
    assert hit >= 0.9
    full = {q: dict(B.nearest([(i, v) for i, v, _ in rows], k=4000)[q]) for q in list(want)[:3]}
    for q in full:
        assert [s for _, s in got[q]] == pytest.approx([full[q][i] for i, _ in got[q]], rel=1e-12)
        assert got[q] == sorted(got[q], key=lambda t: (t[1], t[0]))


def run_nearest_doubles(spark, rows, **more):
    got = {}
    d = spark.createDataFrame(rows, VEC.replace("float", "double"))
    for r in neighbours.nearest(d, F.col("vec_id") % 100 == 0, **more).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return got


@pytest.mark.parametrize("size", [1e6, 1e200])
def test_recall_with_one_huge_vector(spark, size):
    x = np.random.default_rng(5).normal(size=(4000, 24))
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    want = B.nearest([(i, v) for i, v, _ in rows])
    got = run_nearest_doubles(spark, [*rows, (100_000, [float(size * v) for v in x[7]], 0)], share=0.3)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
    assert len(got[100_000]) == 10
    assert [s for _, s in got[100_000]] == pytest.approx([size * np.linalg.norm(x[7])] * 10, rel=1e-4)


def test_few_huge_vectors_are_all_found(spark):
    rows = [(i, [1.0, float(i)], 0) for i in range(5)] + [(5, [1e160, 0.0], 0), (6, [3e160, 1.0], 0), (7, [-1e308, 0.0], 0), (8, [1e308, 0.0], 0)]
    got = run_nearest_doubles(spark, rows)
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert [s for _, s in got[0]][4:] == pytest.approx([1e160, 3e160, 1e308, 1e308])


def test_recall_on_the_given_table(spark, table):
    want = B.nearest(table("embeddings", "vec_id, embedding", "/root/testdata/sf0.1"))
    got = {}
    for r in neighbours.nearest_embeddings(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_equal_vectors_and_odd_rows(spark):
    same, other = [1.0, 2.0, 2.0], [1.0, 2.0, 2.5]
    rows = [(i, same, 0) for i in range(0, 300)] + [(300, other, None), (300, other, None), (301, [0.0, 0.0, 0.0], 1), (302, None, 1), (303, [1.0, None, 1.0], 1)]
    rows += [(304, [1.0], 1), (305, [float("nan"), 1.0, 1.0], 1), (306, [float("inf"), 1.0, 1.0], 1), (None, same, 1), (307, [], 1), (308, [-0.0, 0.0, 3.0], 1)]
    got = run_nearest(spark, rows)
    assert got[0] == [(i, 0.0) for i in range(1, 11)]
    assert got[100] == [(i, 0.0) for i in range(10)]
    assert got[300] == [(i, 0.5) for i in range(10)]
    assert run_nearest(spark, []) == {}
    assert run_nearest(spark, rows[300:301]) == {}


def test_hilbert_neighbours_are_adjacent_cells():
    cells = np.array(np.meshgrid(range(8), range(8), range(8))).reshape(3, -1).T
    keys = neighbours.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


# lines -------------------------------------------------------------------

def test_lines_match_plain_version(spark, table):
    got = line_dedup.dedup_lines(spark, SF).collect()
    assert sorted(tuple(r) for r in got) == sorted(B.lines(table("documents", "doc_id, text")))


def many_lines(seed=4):
    rng = random.Random(seed)
    lines = [f"line {i}" for i in range(40)] + ["Common", "  common\t", "", "   "]
    return [(i, "\n".join(rng.choice(lines) if rng.random() < 0.5 else f"own {i} {j}" for j in range(rng.randint(0, 90))) or None) for i in range(120)]


@pytest.mark.parametrize(("parts", "min_docs"), [(1, 10), (40, 10), (40, 2), (13, 45)])
def test_runs_across_ranges(spark, parts, min_docs):
    rows = many_lines()
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = docs_of(spark, rows)
        out = line_dedup.kept_text(docs, line_dedup.drop_bitmaps(docs, min_docs=min_docs)).select("k_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()
        assert sorted(map(tuple, out)) == sorted(B.lines(rows, min_docs))
        first = line_dedup.kept_text(docs, line_dedup.drop_bitmaps(docs, rule="first")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    text, seen = dict(rows), set()
    order = sorted(dict(rows))
    want = {}
    for i in order:
        kept = []
        for line in (text[i] or "").split("\n"):
            k = line.strip(B.BLANK).translate(B.ASCII)
            if not k or k not in seen:
                kept.append(line)
            seen.add(k)
        want[i] = "\n".join(kept)
    assert {r.k_id: r.text for r in first} == want


@pytest.mark.parametrize("ids", [range(9), [None] * 9])
def test_one_document_over_many_ranges_counts_once(spark, ids):
    texts = [f"own {i}\nshared" for i in range(9)]
    texts[0] += "\nshared" * 600 + "\nmine alone" * 600  # one document of many ranges
    rows = [*zip(ids, texts, strict=True), *[(100 + i, "ten\n" * 40) for i in range(10)]]
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = docs_of(spark, rows)
        out = line_dedup.kept_text(docs, line_dedup.drop_bitmaps(docs)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.text for r in out if r.k_id is None or r.k_id < 100) == sorted(texts)
    assert [r.n_dropped for r in out if r.k_id is not None and r.k_id >= 100] == [40] * 10


def test_lines_of_odd_rows(spark, clashing, no_docs):
    out = line_dedup.kept_text(clashing, line_dedup.drop_bitmaps(clashing, rule="first")).collect()
    assert len(out) == 12
    assert next(r for r in out if r.k_id == 8).text == "line\n\nother"
    assert [r.n_dropped for r in out if r.k_id == 1] in ([0, 0], [1, 1])  # repeats share a decision
    assert line_dedup.kept_text(no_docs, line_dedup.drop_bitmaps(no_docs)).isEmpty()


# tokens ------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    out = token_output.permute(np.arange(n, dtype=np.uint64), n, 99)
    assert sorted(out) == list(range(n))
    if n > 100:
        assert (out != token_output.permute(np.arange(n, dtype=np.uint64), n, 100)).any()


def test_token_round_trip(spark, table):
    end, length = 50256, 1024
    rows = token_output.token_sequences(spark, SF).orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(len(rows))) and sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all(len(r.tokens) == 2 * length for r in rows) and all(r.n_tokens == length for r in rows[:-1])
    stream = np.frombuffer(b"".join(bytes(r.tokens)[: 2 * r.n_tokens] for r in rows), "<u2")
    with open(token_output.VOCABULARY, "rb") as f:
        coder = token_output.Pieces(f.read(), "<u2").encoder
    texts = [coder.decode(part.tolist()) for part in np.split(stream, np.flatnonzero(stream == end) + 1)[:-1] for part in [part[:-1]]]
    docs = [t for _, t in table("documents", "doc_id, text") if t]
    assert sorted(texts) == sorted(docs)
    assert sum(len(coder.encode_ordinary(t)) + 1 for t in docs) == len(stream)


def test_pieces_equal_the_whole_encoding():
    with open(token_output.VOCABULARY, "rb") as f:
        coder = token_output.Pieces(f.read(), "<u2")
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "the", " ", " ", "\n", "\t", " ", "'s", ",", "12", "é", "中", "\r\n", "."]) for _ in range(rng.randint(1, 12)))
        assert coder.text(text) == coder.ids(text), repr(text)


def test_tokens_of_odd_rows_and_files(spark, odd, no_docs, tmp_path):
    out = token_output.training_order(odd, length=16, shard_slots=100)
    rows = sorted(out.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    again = sorted(token_output.training_order(odd.repartition(5), length=16, shard_slots=100).collect(), key=lambda r: r.slot)
    assert [bytes(r.tokens) for r in again] == [bytes(r.tokens) for r in rows]
    uri = f"file://{tmp_path}/shards"
    files = token_output.write_shards(out, uri).collect()
    assert sum(r.n_slots for r in files) == len(rows)
    got = token_output.read_slots(uri, 95, 20, 16, 2, 100)
    assert got.tobytes() == b"".join(bytes(r.tokens) for r in rows[95:115])
    assert token_output.training_order(no_docs).isEmpty()


# quality -----------------------------------------------------------------

def test_quality_on_other_labels(spark):
    big = "/root/testdata/sf0.1"
    labels = read(spark, big, "labels")
    train, rest = labels.where("doc_id % 2 = 0"), {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    got = {r.k_id: r.keep for r in quality.score(read(spark, big, "documents"), train).collect() if r.k_id in rest}
    good = [got[i] for i in rest if rest[i] == 1]
    bad = [got[i] for i in rest if rest[i] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_sparse_sites_shrink_to_their_parents(spark):
    rng = random.Random(6)
    rows = [(f"h{h}", f"p{p}", min(0.99, max(0.01, rng.gauss(0.3 + 0.04 * h, 0.05)))) for h in range(10) for p in range(3) for _ in range(200)]
    rows += [("tiny", "p0", 0.99), (None, None, 0.01)]
    got = {(r.host, r.path): r for r in quality.posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    mean = np.mean([r[2] for r in rows])
    assert got[("h9", "p0")].host_posterior == pytest.approx(0.66, abs=0.02)
    tiny = got[("tiny", "p0")]
    assert mean < tiny.host_posterior < 0.99 and abs(tiny.path_posterior - tiny.host_posterior) < 0.1
    assert (None, None) in got


def test_quality_of_odd_rows(spark, clashing, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (5, 1), (8, 1), (1, None), (None, 1)], "doc_id long, quality int")
    assert quality.score(clashing, labels).count() == 12
    assert quality.kept(clashing, labels).columns == clashing.columns
    assert quality.kept(clashing, labels.limit(0)).count() == 12  # no labels, nothing rejected
    assert quality.score(no_docs, labels).isEmpty()


# toxicity ----------------------------------------------------------------

def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(0)
    x = (rng.random((4000, 5)) < 0.4).astype(float)
    w = np.array([2.0, 1.0, 0.0, -1.0, 3.0])
    noise = rng.logistic(size=4000)
    grade = np.digitize(x @ w + noise, [1.0, 3.0, 5.0])
    got, cuts = toxicity.fit_cumulative(x, grade)
    assert np.abs(got - w).max() < 0.35 and np.abs(cuts - [1, 3, 5]).max() < 0.35


def test_toxicity_on_other_labels(spark):
    big = "/root/testdata/sf0.1"
    docs, labels = read(spark, big, "documents"), read(spark, big, "labels")
    model = toxicity.fit(docs, labels.where("doc_id % 2 = 0"))
    rest = {r.doc_id: r.toxic for r in labels.where("doc_id % 2 = 1").collect()}
    got = {r.k_id: r for r in toxicity.score(docs, model).collect() if r.k_id in rest}
    assert np.mean([got[i].toxic for i in rest if rest[i]]) > 0.8
    assert np.mean([got[i].toxic for i in rest if not rest[i]]) < 0.01


def test_toxicity_of_odd_rows(spark, clashing, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.fit(clashing, labels)
    assert toxicity.score(clashing, model).count() == 12
    none = toxicity.fit(clashing, labels.limit(0))
    assert {r.severity for r in toxicity.score(clashing, none).collect()} == {0.0}
    assert toxicity.score(no_docs, model).isEmpty()


def test_more_insults_are_more_severe(spark):
    rows = [(i, "fine plain words " * 3 + ("vile " * (1 + i % 4) if i % 3 == 0 else "") + f"w{i}", None, None, None) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    got = {r.k_id: r.severity for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert got[1] < 0.5 < got[12] < got[3]
