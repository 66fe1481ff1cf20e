"""Operators on small tables against plain Python and SQL, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from marketspark.llm import bloom_lm, chat, factor_machine, kdtree, langid, line_dedup, mixing, outliers, packing, partenum, text
from marketspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORDS = re.compile(text.WORD)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = "n long, g string, key long, score double, k1 long, sig long, h long, line string, rep long, c string, row string, kept boolean"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"


def words_of(t):
    return WORDS.findall((t or "").translate(LOWER))


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(1)
    long = "\n".join(" ".join(rng.choice(["alpha", "beta", "the", "of", f"w{rng.randrange(999)}"]) for _ in range(40)) for _ in range(700))
    plain = "\n".join(" ".join(f"{w}{rng.randrange(60)}" for w in "some plain words of text here".split()) for _ in range(20))
    rows = [
        (None, plain + "\nand a tail of no id", "en", "a"), (1, None, None, None), (2, "", "en", None), (3, "  \n\t \x0b", "en", "a"),
        (4, long, "en", "a"), (5, plain, "en", "a"), (6, plain, "fr", "b"), (6, plain, "fr", "b"), (7, "One", None, "c"), (8, "one", "en", "c"),
        (9, "###*** $$$", "en", "a"), (10, "Ünïcode wörds 中文 ok", "de", "b"), (None, None, "en", "a"),
    ]
    return spark.createDataFrame([(i, t, g, s, len(t or ""), *[None] * 12) for i, t, g, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


# 1 -- n-gram Jaccard join

def components_of(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = words_of(t)
        sets[i] = frozenset(zip(*[w[k:] for k in range(n)])) if len(w) >= n else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def variants(seed):
    """Copies of two texts with few to many edits, some edits shared, and short texts."""
    rng, out = random.Random(seed), []
    for base in range(2):
        words = [f"b{base}x{rng.randrange(500)}" for _ in range(110)]
        common = [(rng.randrange(110), f"shared{k}") for k in range(3)]
        for _ in range(110):
            w = list(words)
            for at, new in rng.sample(common, rng.randrange(3)):
                w[at] = new
            for _ in range(rng.randrange(7)):
                at = rng.randrange(len(w))
                kind = rng.random()
                if kind < 0.5:
                    w[at] = f"e{rng.randrange(9)}"
                elif kind < 0.75:
                    del w[at]
                else:
                    w.insert(at, f"i{rng.randrange(9)}")
            out.append(" ".join(w))
    out += ["a b c", "A b C", "a b", "", None, "x y z u v w", "x y z u v w k"]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("n, percent, seed", [(4, 85, 1), (5, 80, 2), (3, 70, 3), (4, 90, 4)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, n, percent, seed):
    if seed % 2 == 0:  # half of the cases leave most shingles of the families out of the parts
        monkeypatch.setattr(partenum, "FREQUENT_FROM", 12)
    rows = variants(seed)
    got = partenum.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()
    want = components_of(rows, n, percent)
    assert len(set(c for _, c in want.values())) > 4
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_one_id_on_two_texts(spark):
    rng = random.Random(2)
    x, y = (" ".join(f"{c}{rng.randrange(900)}" for _ in range(80)) for c in "xy")
    rows = [(1, x), (5, x + " end"), (5, y), (9, y + " end"), (9, y + " end"), (7, "alone here in five words"), (7, "alone here in five words"), (7, ""), (7, ""), (None, x), (3, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_shingles"] > 0, r["component_id"]) for r in partenum.near_duplicates(table).collect())
    assert got == Counter([(1, True, 1), (5, True, 1), (5, True, 5), (9, True, 5), (9, True, 5), (7, True, 7), (7, True, 7), (7, False, 7), (7, False, 7), (None, True, 1), (3, False, 3)])
    left = Counter((r["doc_id"], r["text"]) for r in partenum.drop_near_duplicates(table).collect())
    assert left == Counter([(1, x), (5, y), (7, "alone here in five words"), (7, ""), (7, ""), (None, x), (3, None)])


def test_a_family_that_shares_an_edit_forms_few_pairs(spark, monkeypatch):
    """Variants of one text, most of them too far from any hub, all with one edit in common."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(900):
        w = list(words)
        w[100] = "shared"
        for at in rng.sample(range(200), rng.randrange(2, 6)):
            w[at] = f"e{rng.randrange(4)}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    seen = []
    verified = partenum.Join.verified
    monkeypatch.setattr(partenum.Join, "verified", lambda self, pairs: seen.append(pairs.count()) or verified(self, pairs))
    got = partenum.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components_of(rows, 4, 85)
    assert sum(seen) < 8 * len(rows), seen  # over 20,000 pairs share an edit and pass the sketches


def test_a_family_moves_from_an_outer_hub_to_its_centre(spark, empty):
    """Variants of one set around a hub that is far out in the family: all share the hub's own edits, none is linked to it."""
    rng = random.Random(7)
    base = set(range(147))
    sets = {0: base - {*range(13)} | {*range(1000, 1013)}, 1: base - {20} | {1020}}
    for rep in range(2, 400):
        k = rng.randrange(2, 9)
        sets[rep] = base - {*rng.sample(range(147), k)} | {*(2000 + rng.randrange(3000) for _ in range(k))}
    join = partenum.Join(empty, 4, 85)
    rows = [(rep, 0, len(s), len(sets[0]), sorted(s - sets[0]), sorted(sets[0] - s)) for rep, s in sets.items() if rep]
    stars = join.judged(spark.createDataFrame(rows, "rep long, hub long, n long, hub_n long, added array<long>, removed array<long>"))
    near = partenum.materialize(stars, "test-stars")
    got = join.recentred(near).collect()
    assert sorted(r["rep"] for r in got) == sorted(r[0] for r in rows)
    for r in got:
        a, h = sets[r["rep"]], sets[r["hub"]]
        assert (r["n"], r["hub_n"], sorted(r["added"]), sorted(r["removed"])) == (len(a), len(h), sorted(a - h), sorted(h - a))
        assert r["linked"] == (100 * len(a & h) >= 85 * len(a | h)) and r["close"] == (len(a ^ h) * 185 <= 60 * (len(a) + len(h)))
    assert near.where("linked").count() < 40 and sum(r["linked"] for r in got) > 350


@pytest.mark.parametrize("n, percent, seed, large", [(4, 85, 5, 10**9), (5, 80, 6, 2)])
def test_rounds_with_local_hubs_equal_brute_force(spark, monkeypatch, n, percent, seed, large):
    monkeypatch.setattr(partenum, "FEW", 0)
    monkeypatch.setattr(partenum, "LARGE", large)
    rows = variants(seed)
    got = partenum.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components_of(rows, n, percent)


def test_near_duplicates_of_odd_rows(odd, empty):
    got = Counter((r["doc_id"], r["component_id"]) for r in partenum.near_duplicates(odd).collect())
    assert got[(6, 5)] == 2 and got[(5, 5)] == 1 and got[(8, 7)] == 1 and got[(1, 1)] == got[(2, 2)] == got[(3, 3)] == 1
    assert sum(got.values()) == odd.count()
    assert partenum.near_duplicates(empty).count() == 0
    kept = partenum.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 2, 3, 4, 5, 7, 9, 10]
    twice = odd.where("doc_id = 6 OR doc_id = 9 OR doc_id IS NULL")
    assert Counter(r["doc_id"] for r in partenum.drop_near_duplicates(twice).collect()) == Counter({None: 2, 6: 1, 9: 1})


# 2 -- quality classifier

def test_quality_is_learned(spark):
    got = QUERIES["op2_quality_classifier"](spark, SF)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema][:4] == [
        ("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.collect()
    assert len(rows) == 200 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    known = [r for r in rows if r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in known]) > 0.9


def test_classifier_on_odd_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, label int")
    machine = factor_machine.train(odd, none)
    scored = factor_machine.score(odd, machine, "doc_id", F.col("score").alias("old")).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    labels = spark.createDataFrame([(5, 1), (9, 0), (9, None), (None, 1), (99, 1)], "doc_id long, label int")
    machine = factor_machine.train(odd, labels)
    by_id = {r["doc_id"]: r["score"] for r in factor_machine.score(odd, machine, "doc_id").collect()}
    assert by_id[5] > 0.7 > by_id[9]
    assert factor_machine.score(empty, machine, "doc_id").count() == 0


# 3 -- line dedup

def edited(rng, s, k):
    s = list(s)
    for _ in range(k):
        at = rng.randrange(len(s))
        s[at : at + rng.randrange(2)] = rng.choice(["", "é", "q"])
    return "".join(s)


def test_segment_keys_and_banded_distance(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(600):
        a = "".join(rng.choice("abcé") for _ in range(rng.randint(19, 24)))
        pairs.append((a, edited(rng, a, rng.randrange(5))))
    df = spark.createDataFrame(pairs, "a string, b string")
    for tau in (1, 2, 3):
        meet = F.arrays_overlap(line_dedup.segment_keys(F.col("a"), F.length("a"), tau), line_dedup.segment_keys(F.col("b"), F.length("b"), tau))
        for r in df.select("a", "b", F.levenshtein("a", "b").alias("d"), line_dedup.banded_distance(F.col("a"), F.col("b"), tau).alias("e"), meet.alias("m")).collect():
            assert (r["e"] == r["d"]) if r["d"] <= tau else r["e"] > tau, r
            assert r["m"] or r["d"] > tau, r


def test_lines_of_a_hot_family(spark):
    rng = random.Random(8)
    base = "a line that stands in very many of the documents here"
    texts = ["\n".join([edited(rng, base, rng.randrange(5)), base if i % 3 else "short", f"own line number {i} of the text, long enough"]) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    lines = [(i, k, s.strip(" ")) for i, t in rows for k, s in enumerate(t.split("\n"))]
    first = {}
    for i, k, s in lines:
        first.setdefault(s, (i, k))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
            row = new
        return row[-1]

    origin = {s: min([f, *(g for u, g in first.items() if g < f and min(len(u), len(s)) >= 20 and abs(len(u) - len(s)) <= 2 and distance(u, s) <= 2)]) for s, f in first.items()}
    got = line_dedup.line_verdicts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["line_no"], r["kept"], r["first_doc"], r["first_line"]) for r in got) == sorted(
        (i, k, origin[s] == (i, k), *origin[s]) for i, k, s in lines)


def test_short_lines_and_texts_that_share_an_id(spark):
    x = "a line of some length that stands first"
    rows = [(1, x), (5, x + "s"), (5, "a wholly different line of the same id"), (7, "short line one\n\n \t \nok"), (8, "own words here\nshort line one\nok\nno"), (9, "okk")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["line_no"], r["first_doc"], r["first_line"], r["kept"]) for r in line_dedup.line_verdicts(table).collect()}
    assert got == {(1, 0, 1, 0, True), (5, 0, 1, 0, False), (5, 0, 5, 0, True), (7, 0, 7, 0, True), (7, 3, 7, 3, True), (8, 0, 8, 0, True),
                   (8, 1, 7, 0, False), (8, 2, 7, 3, False), (8, 3, 8, 3, True), (9, 0, 9, 0, True)}
    left = sorted((r["doc_id"], r["text"]) for r in line_dedup.drop_lines(table).collect())
    assert left == [(1, x), (5, "a wholly different line of the same id"), (7, "short line one\n\n \t \nok"), (8, "own words here\nno"), (9, "okk")]
    spared = dict((r["doc_id"], r["text"]) for r in line_dedup.drop_lines(table.where("doc_id > 6"), spare=9).collect())
    assert spared[8] == "own words here\nok\nno"


def test_drop_lines(odd, empty):
    out = line_dedup.drop_lines(odd)
    assert out.columns == odd.columns
    rows = out.collect()
    by_id = Counter(r["doc_id"] for r in rows)
    # 6 is a copy of 5 and goes; rows without words, without text or without id stay as they are.
    assert by_id == Counter({None: 2, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 1, 8: 1, 9: 1, 10: 1})
    texts = {r["doc_id"]: r for r in odd.collect()}
    assert all(r["text"] == texts[r["doc_id"]]["text"] for r in rows if r["doc_id"] in (1, 2, 3, 5, 7))
    assert all(r["n_chars"] == len(r["text"] or "") for r in rows)
    assert line_dedup.drop_lines(empty).count() == 0 and line_dedup.line_verdicts(empty).count() == 0


# 4 -- packing

def test_packing_round_trip(spark, odd, empty):
    rows = packing.pack(odd.repartition(2)).collect()
    encode = packing.encoder()
    want, got = Counter(), {}
    for r in odd.collect():
        want[(r["doc_id"], encode.whole(r["text"]) + b"\0\0\0\0" if r["text"] else b"\0\0\0\0")] += 1
    spans = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and (r["length"] == 2048 or r["piece"] == 0)
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        got.setdefault((r["doc_id"], r["piece"]), []).append(r)
    for own in spans.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    long = [r for r in rows if r["doc_id"] == 4]
    assert len(long) > 5 and b"".join(r["ids"] for r in sorted(long, key=lambda r: r["piece"])) in {k[1] for k in want}
    assert Counter((r["doc_id"], r["ids"]) for r in rows if r["doc_id"] != 4) == Counter({k: v for k, v in want.items() if k[0] != 4})
    assert packing.pack(empty).count() == 0


def test_packing_query_is_near_the_bound(spark):
    rows = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) + 2
    assert all(0 <= r["ids_crc32"] < 2**32 for r in rows)


# 5 -- quality rules

def base_counts(t):
    w = WORDS.findall(t or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = {k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in (i, i + 1, i + 2)}
    lines = [s for s in (t or "").split("\n") if WORDS.search(s)]
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit), failed


def test_base_counts(spark, odd):
    for docs in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        got = Counter(tuple(r[c] for c in [*outliers.BASE, "base_failed"]) for r in outliers.quality_rules(docs).collect())
        assert got == Counter(base_counts(r["text"]) for r in docs.select("text").collect())


def test_robust_estimate_ignores_a_third_of_outliers(spark):
    rng = np.random.default_rng(4)
    good, bad = rng.normal(500, 120, (400, 5)), rng.normal(1500, 60, (130, 5))
    x = np.floor(np.concatenate([good, bad]))
    df = spark.createDataFrame([("g", *map(int, r)) for r in x] + [("one", 1, 2, 3, 4, 5)], ["g", *[f"x_{n}" for n in outliers.NAMES]])
    est = {r["g"]: r for r in outliers.estimates(df).collect()}
    assert all(abs(est["g"][f"m{i}"] - 500) < 40 for i in range(5)) and est["one"]["m4"] == 5.0
    scored = df.where("g = 'g'").join(outliers.estimates(df), "g").select(outliers._distance().alias("d")).collect()
    d = np.array([r["d"] for r in scored])
    assert np.sort(d)[:400].max() < np.sort(d)[400:].min()


def test_rules_keep_good_documents(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in outliers.quality_rules(docs).collect()}
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        if r["quality"] == 1:
            assert rows[r["doc_id"]]["kept"] != rows[r["doc_id"]]["base_failed"]
    kept = outliers.keep_good(odd)
    assert kept.columns == odd.columns and outliers.keep_good(empty).count() == 0 and outliers.quality_rules(empty).count() == 0
    # The null id also stands on a row that fails, so both rows of it go; 4 repeats its windows.
    assert sorted(r["doc_id"] for r in kept.collect()) == [5, 6, 6]


# 6 -- chat

def fold(events):
    """Final (role, text) messages of one conversation's sorted events."""
    out = []
    for event, message, role, said in events:
        at = next((m for m in out if m["id"] == message), None)
        if at is None:
            at = {"id": message, "role": role, "text": ""}
            out.append(at)
        at["role"] = at["role"] or role
        if event == "regenerate":
            del out[out.index(at) + 1 :]
        at["text"] = (said or "") if event in ("message", "edit", "regenerate") else at["text"] + (said or "")
    return [(m["role"] or "", m["text"]) for m in out]


def digests(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_event_log_is_folded(spark):
    rng, rows = random.Random(5), []
    pieces = ["<|im_end|>", "\n", "a|b", "\\", "\\p", "ok ", "", None, "<|im_start|>assistant\n", "é"]
    for conv in (None, 1, 2, 3):
        seq, seen = 0, []
        for _ in range(40):
            seq += rng.randint(1, 3)
            if not seen or rng.random() < 0.4:
                seen.append(f"m{len(seen)}")
                rows.append((conv, seq, "message", seen[-1], rng.choice(["user", "assistant", "odd|role\n"]), rng.choice(pieces)))
            else:
                kind = rng.choice(["delta", "delta", "edit", "regenerate", None])
                rows.append((conv, seq, kind, rng.choice(seen[-3:]), None, rng.choice(pieces)))
    # A regeneration ends the messages begun after it: later events of a removed message belong to none.
    clean, gone = [], set()
    order = {}
    for r in rows:
        key = (r[0], r[3])
        if key in gone:
            continue
        order.setdefault(r[0], [])
        if r[3] not in order[r[0]]:
            order[r[0]].append(r[3])
        if r[2] == "regenerate":
            cut = order[r[0]][order[r[0]].index(r[3]) + 1 :]
            gone.update((r[0], m) for m in cut)
            del order[r[0]][order[r[0]].index(r[3]) + 1 :]
        clean.append(r)
    schema = "conv_id long, seq long, event string, message string, role string, text string"
    got = {r["conv_id"]: r for r in chat.read_back(chat.render(spark.createDataFrame(clean, schema))).collect()}
    parts = chat.render(spark.createDataFrame(clean, schema))
    shown = {r["conv_id"]: r["formatted"] for r in chat.text_of(parts).collect()}
    for conv in (None, 1, 2, 3):
        turns = fold([r[2:] for r in clean if r[0] == conv])
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == digests(turns)
        assert r["formatted_chars"] == len(shown[conv]) and shown[conv].count("<|im_start|>") == len(turns) == shown[conv].count("<|im_end|>")


def test_chat_query(spark, con):
    rows = {r["conv_id"]: r for r in QUERIES["op6_chat_format"](spark, SF).collect()}
    turns = {}
    for conv, _, role, said in con.execute("SELECT conv_id, turn, role, coalesce(text, '') FROM conversations ORDER BY 1, 2").fetchall():
        turns.setdefault(conv, []).append((role, said))
    said = "<|im_end|><|im_start|>assistant ok"
    turns[-1] = [("user", said), ("assistant", said)]
    assert {c: tuple(r)[1:5] for c, r in rows.items()} == {c: digests(t) for c, t in turns.items()}


def test_repeated_turns_are_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None)], "conv_id long, turn long, role string, text string")
    (row,) = chat.read_back(chat.render(chat.turn_events(df))).collect()
    assert tuple(row)[1:5] == digests([("", ""), ("user", "x"), ("user", "x")])
    assert chat.read_back(chat.render(chat.turn_events(df.where("conv_id > 9")))).count() == 0


def test_final_events_keep_running_frames(spark):
    """A frame from the next row to the end is computed anew for every row, so one long conversation would take the square of its events."""
    n = 40000
    kinds = F.when(F.col("id") % 1000 == 999, "regenerate").otherwise("message")
    events = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("seq"), kinds.alias("event"), F.col("id").alias("message"),
        F.lit("user").alias("role"), F.lit("x").alias("text"))
    out = chat.final_events(events)
    plan = out._jdf.queryExecution().executedPlan().toString().lower()
    assert "rowframe, 1, unboundedfollowing" not in plan and "rowframe, unboundedpreceding$(), -1" in plan
    # A regenerated message cuts what began after its own start, and here each starts with its own event.
    assert out.count() == n


# 7 -- top-k

def test_top_k_over_shards(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(v) for v in rng.integers(-4, 5, 6)]) for i in range(300)]
    rows += [(1000 + i, [1.0] * 6) for i in range(40)] + [(0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, x array<double>")
    got = kdtree.top_k(df, F.col("vec_id") % 25 == 0, 5, shard_rows=60, block_queries=4).collect()
    own, want = dict(rows), set()
    for q in own:
        if q % 25 == 0:
            best = sorted((-int(np.dot(own[q], v)), i) for i, v in own.items() if i != q)[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_odd_vectors_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, -0.3]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0]), (7, [1.0, 0.0]), (8, [1.0])]
    df = kdtree.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert {r["vec_id"]: r["x"] for r in df.collect()} == {1: [128.0, -77.0], 7: [256.0, 0.0], 8: [256.0]}
    assert [tuple(r) for r in kdtree.top_k(df, F.col("vec_id") == 1).collect()] == [(1, 1, 7, 128 * 256)]
    assert kdtree.top_k(df.where("vec_id > 99"), F.col("vec_id") == 1).count() == 0


# 8 -- mixing

def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = QUERIES["op8_source_mix"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, QUERIES["op8_source_mix"](spark, "/root/testdata/sf0.01").collect())) == sorted(map(tuple, rows))
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    want = mixing.targets(sizes, mixing.cycled_weights(sizes))
    largest = max(r["size"] for r in rows)
    assert len(rows) == docs.count() and all(r["source_size"] == sizes[r["source"]] and r["target"] == want[r["source"]] for r in rows)
    assert all(abs(taken[s] - want[s]) <= largest / 2 + 1 for s in want)


def test_overlapping_sources(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([["a"], ["b"], ["a", "b"], ["b", None], []]), rng.randint(0, 50)) for i in range(400)] + [(None, ["a"], 5), (0, None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, s array<string>, size long")
    out = mixing.mix_sources(df, F.col("s"), F.col("size"), F.col("doc_id"))
    got = out.collect()
    assert out.columns[:3] == df.columns and len(got) == len(rows)
    assert all(r["mix_taken"] <= 3 * r["size"] for r in got) and all(r["mix_taken"] == 0 for r in got if not r["s"])
    total = sum(r["size"] for r in got if r["s"])
    assert abs(sum(r["mix_taken"] for r in got) - total) <= 5 * 50
    with pytest.raises(ValueError):
        mixing.mix_sources(df, F.col("s"), F.col("size"), F.col("doc_id"), max_patterns=2)


def test_mix_of_odd_rows(odd, empty):
    rows = mixing.mix_documents(odd).collect()
    assert len(rows) == odd.count() and all(r["taken"] == 0 for r in rows if r["size"] == 0)
    out = mixing.repeat_by_mix(odd)
    assert out.columns == odd.columns and out.count() > 0
    assert mixing.repeat_by_mix(empty).count() == 0


# 9 -- language

def test_language_is_learned(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_language_id"](spark, SF).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"]]) > 0.95


def test_language_of_odd_rows(spark, odd, empty):
    langs, model = langid.train(odd)
    assert langs == ["de", "en", "fr"]
    rows = {r["doc_id"]: r for r in langid.predict(odd.select("doc_id", "text"), F.col("text"), langs, model).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (1, 2, 3, 9)) and rows[10]["lang_pred"] == "de"
    none, zero = langid.train(empty)
    assert none == [] and {r["lang_pred"] for r in langid.predict(odd.select("text"), F.col("text"), none, zero).collect()} == {"und"}
    assert langid.predict(empty.select("text"), F.col("text"), langs, model).count() == 0


# 10 -- language model

@pytest.mark.parametrize("limits", [{}, {"head_words": 300, "vocabulary": 100}])
def test_language_model(spark, odd, limits):
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), odd):
        given = docs.select("doc_id", "text").collect()
        out = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
        tokens = [(r["doc_id"], words_of(r["text"]) + [None]) for r in given]
        count = Counter(w for i, t in tokens if not out(i) for w in t)
        n, v = sum(count.values()), len(count)
        want = Counter()
        for i, t in tokens:
            base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
            want[(i, out(i), len(t), sum(count[w] > 0 for w in t), n, round(base, 4))] += 1
        rows = bloom_lm.score_documents(docs, text.crc_remainder(F.col("doc_id"), 10) == 0, **limits).collect()
        assert Counter((*tuple(r)[:5], round(r["base_score"], 4)) for r in rows) == want
        assert all(r["score"] < 0 for r in rows)
        if not limits and docs is not odd:
            held = [r for r in rows if r["held_out"]]
            assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_without_training_rows(odd, empty):
    rows = bloom_lm.score_documents(odd, F.lit(True)).collect()
    assert len(rows) == odd.count() and all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in rows)
    assert bloom_lm.score_documents(empty, F.lit(False)).count() == 0


def test_language_model_is_near_exact_counts_beyond_the_broadcast(spark):
    """More distinct words and bigrams than the bound on the filter in every worker has room for; all bigrams are told apart."""
    rng = random.Random(12)
    partner = {}
    texts = []
    for i in range(60):
        out = []
        while len(out) < 5000:
            w = f"w{rng.randrange(90000)}"
            out += [w, partner.setdefault(w, f"p{len(partner)}")]
        texts.append(" ".join(out))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    train = [[None, *t.split(" "), None] for i, t in enumerate(texts) if i >= 6]
    one, two = Counter(w for t in train for w in t[1:]), Counter(b for t in train for b in zip(t, t[1:]))
    n, v = sum(one.values()), len(one)
    assert v > 1 << 16
    middle = {c: float(bloom_lm.expected(bloom_lm.quantise(np.array([c])))[0]) for c in {*one.values(), *two.values()}} | {0: 0.0}

    def exact(t):
        total = 0.0
        for a, b in zip([None, *t], [*t, None]):
            p = (middle[one[b]] + bloom_lm.ADD) / (n + bloom_lm.ADD * (v + 1))
            linked = min(1.0, middle[two[a, b]] / max(middle[one[a]], 1)) if one[a] else 0.0
            total += math.log10(bloom_lm.LAMBDA * linked + (1 - bloom_lm.LAMBDA) * p)
        return total / (len(t) + 1)

    def scores(**limits):
        return {r["doc_id"]: r for r in bloom_lm.score_documents(docs, F.col("doc_id") < 6, **limits).collect()}

    held, sent = scores(), scores(broadcast_bits=1 << 20, head_words=1000)
    assert held.keys() == sent.keys() == set(range(60))
    for i, t in enumerate(texts):
        assert sent[i]["score"] == pytest.approx(held[i]["score"], abs=1e-6)
        assert sent[i]["base_score"] == pytest.approx(held[i]["base_score"], abs=1e-6)
        # A false positive lifts an absent bigram by at most five powers of ten here.
        assert abs(held[i]["score"] / held[i]["n_tokens"] - exact(t.split(" "))) < (5 * bloom_lm.FALSE_POSITIVES if i < 6 else 0.01), i


def test_language_model_by_segment_on_odd_rows(odd, empty):
    by_segment = lambda df: sorted(map(repr, bloom_lm.score_documents(df, F.col("doc_id") == 5, broadcast_bits=0).collect()))
    assert by_segment(odd) == sorted(map(repr, bloom_lm.score_documents(odd, F.col("doc_id") == 5).collect()))
    assert by_segment(empty) == []
