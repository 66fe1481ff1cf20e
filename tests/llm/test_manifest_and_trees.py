"""Vantage-point near-duplicates, the Merkle manifest and the conversation trie against plain Python, with nulls, ties, repeats and empty tables."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
import xxhash
from pyspark.sql import functions as F

from marketspark.llm import merkle, prefix_trie, ranking, vantage
from marketspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = "part int, rank long, total long, tree string, node string, f long, a long, x long, block long, shard int, path string"


# ranks

def test_ranks_number_each_key_over_many_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "hot", "hot", "hot"]), rng.randrange(40), i) for i in range(3000)]
    got = ranking.ranked(spark.createDataFrame(rows, "k string, o long, i long").repartition(7), "k", ["o", "i"]).collect()
    want = {}
    for key in {k for k, _, _ in rows}:
        for rank, (_, o, i) in enumerate(sorted(r for r in rows if r[0] == key)) if key is not None else enumerate(sorted(((0, o, i) for k, o, i in rows if k is None))):
            want[i] = rank
    assert {r["i"]: r["rank"] for r in got} == want
    sizes = Counter(k for k, _, _ in rows)
    assert all(r["total"] == sizes[r["k"]] for r in got)


# 11 -- vantage-point trees

def plain_fingerprint(t):
    words = (t or "").translate(LOWER).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, reach=4):
    """Component number of each distinct fingerprint, by comparing all pairs."""
    prints = sorted(set(prints))
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= reach:
            parent[root(a)] = root(b)
    return {f: root(f) for f in prints}


def clusters(seed, n=1200):
    """Random fingerprints, families of few flips around some, and chains of links."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for f in out[:12]:
        out += [f ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 7))) for _ in range(60)]
    f = out[20]
    for _ in range(40):
        f ^= sum(1 << b for b in rng.sample(range(64), 4))
        out.append(f)
    return sorted(set(out))


@pytest.mark.parametrize("seed, rows", [(1, 100), (2, 400), (3, 5000)])
def test_links_connect_what_all_pairs_connect(spark, seed, rows):
    prints = clusters(seed)
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in prints]
    got = vantage.links(spark.createDataFrame(signed, "f long").repartition(5), shard_rows=rows).collect()
    want, parent = plain_components(prints), {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for r in got:
        a, b = r["a"] % 2**64, r["b"] % 2**64
        assert want[a] == want[b]  # no link where there is none
        parent[root(a)] = root(b)
    groups = defaultdict(set)
    for f in prints:
        groups[want[f]].add(root(f))
    assert all(len(g) == 1 for g in groups.values())  # none is lost
    # A large family gives about one link for each fingerprint and shard, not one for each pair.
    assert len(got) <= 4 * len(prints)


def test_a_family_of_thousands_is_searched_without_its_pairs():
    rng, centre = random.Random(5), 0x0123456789ABCDEF
    family = np.unique(np.array([centre ^ sum(1 << b for b in rng.sample(range(40), rng.randrange(4))) for _ in range(6000)], np.uint64))
    shard = vantage.Shard(family)
    assert (shard.label == 0).all()
    outside = np.array([centre ^ (1 << 50), centre ^ ((1 << 60) - 1)], np.uint64)
    assert (shard.search(outside) >= 0).tolist() == [True, False]


def test_fingerprints_and_components_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(9001, "One two"), (9002, "one  TWO"), (9003, None), (9000, "\n"), (9004, "Ünï 中文 a b c d"), (None, "one two"), (None, "only here, without an id")]
    long = " ".join(f"w{i % 977}" for i in range(90_000))
    rows += [(9005, long), (9006, long + " end"), (9006, "quite another text under this id"), (9006, "quite another text under this id")]
    table = spark.createDataFrame([(i, t, *[None] * 11) for i, t in rows], f"doc_id long, text string, {CLASH}")
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    part = plain_components([f for _, f in prints])
    least = defaultdict(list)
    for i, f in prints:
        least[part[f]].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    want = Counter((i, f"{f:016x}", least[part[f]]) for i, f in prints)
    got = vantage.near_duplicates(table)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(tuple(r) for r in got.collect()) == want
    assert len({c for _, _, c in want}) < len(set(rows))
    assert vantage.near_duplicates(table.limit(0)).count() == 0
    assert vantage.near_duplicates(table.where("doc_id = 9001")).first()["component_id"] == 9001


# 12 -- Merkle manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text=...):
    parts = []
    for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"] if text is ... else text):
        parts.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*parts)


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_audit(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_levels([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names}
    top = plain_levels([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            own = leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                own = plain_leaf(r, r["text"] and r["text"].translate(LOWER))
            siblings = []
            for levels, k in ((trees[s], i), (top, at)):
                for level in levels[:-1]:
                    run = level[k // 16 * 16 : k // 16 * 16 + 16]
                    siblings += run[: k % 16] + run[k % 16 + 1 :]
                    own = h(*run[: k % 16], own, *run[k % 16 + 1 :])
                    k //= 16
            out.append((r["doc_id"], leaf, trees[s][-1][0], top[-1][0], h(*siblings), own, own == top[-1][0]))
    return Counter(out)


def audited(table):
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = merkle.leaf(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), lowered)
    return merkle.audit(table, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, tampered))


def ledger(spark, n, sources, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["x", "Some Text", None, "", "Ünï", "y" * 5000]), rng.choice(["en", None]), rng.choice(sources), rng.choice([None, i])) for i in range(n)]
    rows += [rows[0], rows[0], (None, "no id", None, sources[0], 1), (None, "No id", None, sources[0], 1), (5, "other text", "en", sources[0], None)]
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, *[None] * 11) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")


@pytest.mark.parametrize("n, sources", [(700, ["hot", "hot", None, "b", "", "ü", "z"]), (300, [f"s{k}" for k in range(40)]), (60, ["one"]), (9000, ["big"] * 50 + ["b"])])
def test_audit_equals_plain_trees(spark, n, sources):
    table = ledger(spark, n, sources).repartition(6)
    got = audited(table)
    assert got.dtypes == [("doc_id", "bigint"), *[(c, "string") for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", "boolean")]
    assert Counter(tuple(r) for r in got.collect()) == plain_audit(table.collect())


def test_small_and_empty_manifests(spark):
    one = ledger(spark, 1, ["a"]).where("doc_id = 0").limit(1)
    row = audited(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == h("") and row["verified"] == (plain_audit(one.collect()).most_common(1)[0][0][6])
    assert audited(one.limit(0)).count() == 0


def test_log_is_the_postorder_of_every_tree(spark):
    table = ledger(spark, 9000, ["big"] * 30 + ["b", "c"])
    own = merkle.leaf(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))
    manifest = merkle.Manifest(table.select("source", "doc_id", own.alias("node"), F.lit(None).cast("binary").alias("claim")))
    logs = defaultdict(list)
    for r in manifest.nodes().collect():
        logs[r["source"]].append((r["position"], r["level"], bytes(r["node"])))
    leaves = defaultdict(list)
    for r in table.collect():
        leaves[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
    assert max(map(len, leaves.values())) > merkle.SPAN
    for source, found in leaves.items():
        nodes = [bytes.fromhex(x[2]) for x in sorted(found)]
        levels = merkle.height(len(nodes))
        assert [(p, n) for p, _, n in sorted(logs[source])] == list(enumerate(merkle.append_log(nodes, levels)))
    (root,) = manifest.root().collect()
    assert root["root"].hex() == next(iter(plain_audit(table.collect())))[3]


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4096, 4097])
def test_positions_are_closed_form(leaves):
    nodes = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(leaves)]
    levels = merkle.height(leaves)
    log = merkle.append_log(nodes, levels)
    rows, seen = nodes, set()
    for level in range(levels + 1):
        for i, node in enumerate(rows):
            at = merkle.position(level, i, leaves, levels)
            assert log[at] == node and at not in seen
            seen.add(at)
        rows = [merkle.digest(rows[k : k + 16]) for k in range(0, len(rows), 16)]
    assert seen == set(range(len(log)))


# 13 -- conversation trie

def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        head = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:head] + own[c][head:]
    return out


def plain_trie(sequences):
    members = defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(sequences[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def talks(seed):
    rng, rows = random.Random(seed), []
    for c in [*range(0, 45), *range(100, 130), *range(305, 320), 900, 70001]:
        for t in range(rng.choice([1, 2, 3, 3, 4, 6, 9, 20, 37])):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t > 3 else "user", f"turn {t} {rng.randrange(2 if t < 6 else 1)} é中"))
    rows += [(7, None, None, None), (7, None, "user", None), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 1, "", "TIE"), (None, 1, "user", "no id"), (12, 2, "user", "long " * 4000)]
    rng.shuffle(rows)
    return rows


def query_trie(table):
    conv = F.col("conv_id")
    turns = prefix_trie.ordered_turns(table)
    return prefix_trie.trie(prefix_trie.regrafted(turns, conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6, 5))


@pytest.mark.parametrize("seed, stride", [(1, 1024), (2, 2)])
def test_trie_equals_plain_prefixes(spark, monkeypatch, seed, stride):
    monkeypatch.setattr(prefix_trie, "STRIDE", stride)
    rows = talks(seed)
    table = spark.createDataFrame([(*r, *[None] * 11) for r in rows], f"conv_id long, turn long, role string, text string, {CLASH}")
    want = plain_trie(rebuilt(rows))
    assert any(d > 16 for _, d, *_ in want)
    assert Counter(tuple(r) for r in query_trie(table).collect()) == want
    assert query_trie(table.limit(0)).count() == 0


def test_growing_logs_and_turnless_conversations(spark):
    """Conversation c is the first c of 60 turns; chains follow the longest, so nothing hangs deep."""
    rows = [(1000 + c, t, "user", f"t{t}") for c in range(1, 60) for t in range(c)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = prefix_trie.ordered_turns(turns).select("conv_id", "pos", "turn_id")
    bare = spark.createDataFrame([(3, None, None)], "conv_id long, pos long, turn_id binary")
    sequences = {1000 + c: [("user", f"t{t}") for t in range(c)] for c in range(1, 60)} | {3: []}
    assert Counter(tuple(r) for r in prefix_trie.trie(made.unionByName(bare)).collect()) == plain_trie(sequences)


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_prefix_trie"])
def test_new_queries_equal_sql(spark, name):
    assert oracle.compare(QUERIES[name](spark, SF), oracle.connect(SF), ORACLES[name]) is None
