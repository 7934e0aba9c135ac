import numpy as np
import xxhash
from pyspark.sql import functions as F

from wavelake.llm import simhash

from .helpers import ODD, documents, prose


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_components(rows, radius=3):
    fps = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                label[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return sorted((repr(rows[i][0]), f"{fps[i]:016x}",
                   repr(min((d for d in groups[root(i)] if d is not None), default=None))) for i in range(len(rows)))


def result(df):
    return sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in df.collect())


def test_matches_all_pairs_with_odd_rows(spark):
    base = prose(1, 40)
    near = [t + " extra" for t in base[:15]] + [t.replace("a", "A") for t in base[:10]]
    rows = list(enumerate([*base, *near, *ODD])) + [(3, base[3]), (3, base[3]), (None, base[5]), (None, "only here")]
    assert result(simhash.near_duplicates(documents(spark, rows))) == plain_components(rows)


def test_fingerprint_equals_the_builtin_hash(spark):
    text = "Alpha beta  gamma"
    h = spark.range(1).select(F.xxhash64(F.lit("alpha beta gamma")).alias("h")).first().h
    assert simhash.fingerprint(text) == h % (1 << 64) == plain_fingerprint(text)


def test_forest_and_dense_shards_find_every_pair(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 5, dtype=np.uint64)
    fp = np.unique([np.uint64(int(rng.choice(base)) ^ sum(1 << int(b) for b in rng.choice(20, 5))) for _ in range(800)])
    tree = rng.integers(0, 2, len(fp))
    found = set()
    for q, i in simhash.BKForest(fp, tree).search(fp, tree, 3):
        found |= set(zip(q.tolist(), i.tolist(), strict=True))
    near = (np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3) & (tree[:, None] == tree[None, :])
    assert found == set(zip(*[x.tolist() for x in np.nonzero(near)], strict=True))
    # blocks of a hot shard: the links connect what all pairs connect
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint")
    small = {(r.node, r.root) for r in simhash.components(simhash.links(df, shard_size=16)).collect()}
    large = {(r.node, r.root) for r in simhash.components(simhash.links(df)).collect()}
    assert small == large and large


def test_long_chain_is_one_component(spark):
    df = spark.createDataFrame([(i + 1, i) for i in range(60)], "a bigint, b bigint")
    assert {(r.node, r.root) for r in simhash.components(df).collect()} == {(i, 0) for i in range(1, 61)}


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
