"""Line deduplication by a segment-partition edit join.

Two lines are near when their edit distance is at most ``tau``.  A line of length l
is cut into tau + 1 segments; a line within tau edits contains one of them
unchanged, at a place that its number and both lengths bound.  So every distinct line
sends its own segments and, for each shorter length up to tau less, the substrings
that may be a segment there; only lines that meet under one (length, number, text) key are
compared.  Everything is DataFrame expressions.

Pairs that a parity signature of their characters (64 bits) or Spark's thresholded ``levenshtein`` rules out are passed over in
the join; a banded bit-parallel recurrence (``banded_distance``), one column of the band in the
bits of a number, decides the others and gives their distance.

Lines of fewer than ``EDIT_FROM`` characters are the same line only where they are equal: in so few, two
edits make another line (a number, a name), and their segments of a few characters would be shared by all texts.
A line without a word is blank and has no verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from .text import WORD

TAU = 2
#: Characters from which lines are joined by edits, a tenth of them for two; at least (tau + 1)^2, so that every substring lies inside.
EDIT_FROM = 20
#: Most document ids that are sent to every executor when the texts of candidates are fetched: 16 MB.
MOST_SENT = 1_000_000
_SHIFT = 1 << 32


def _key(length: int | Column, number: int, segment: Column) -> Column:
    return F.xxhash64(length, F.lit(number), segment)


def segment_keys(line: Column, n: Column, tau: int = TAU) -> Column:
    """Array of the keys under which a line of ``n`` characters meets every line of at most its length within ``tau`` edits.

    Lines need (tau + 1)^2 characters, so that every substring lies inside.

    Segments are numbered from 0; the first ones have l div (tau + 1)
    characters and the last l mod (tau + 1) have one more.  A segment that starts at p in the shorter line starts between
    p - left and p + right in the longer one, where with i edits before it and tau - i after, and d the
    difference in length: |shift| <= i and |shift - d| <= tau - i.
    """
    parts, keys = tau + 1, []
    for less in range(tau + 1):
        size = n - less
        base, longer = (size / parts).cast("int"), size % parts
        for i in range(parts):
            long_before = F.greatest(F.lit(0), F.lit(i - parts) + longer)
            start = base * i + long_before
            width = base + (longer >= parts - i).cast("int")
            for shift in range(-i, i + 1):
                if abs(shift - less) <= tau - i:
                    keys.append(_key(size, i, F.substr(line, start + (shift + 1), width)))
    return F.array_distinct(F.array(*keys))


def banded_distance(a: Column, b: Column, tau: int = TAU) -> Column:
    """Edit distance of two texts whose lengths differ by at most ``tau``; right up to ``tau``, and above it otherwise.

    Bit k of a column's words stands for the pair (a[j + k - tau], b[j]): the vertical
    differences of the band around the diagonal are its two words, +1 and -1.  One column is a few
    bit operations; the last row's value is followed along the band's lower edge, then across.
    """
    width = 2 * tau + 1
    full = (1 << width) - 1
    n, m = F.length(a), F.length(b)
    state = F.struct(
        F.lit(full & ~((1 << tau) - 1)).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"), F.lit(tau).alias("d"))

    def column(s: Column, j: Column) -> Column:
        match = F.lit(0).cast("long")
        for k in range(width):
            i = j + (k - tau)
            same = (i >= 0) & (i < n) & (F.substr(a, i + 1, F.lit(1)) == F.substr(b, j + 1, F.lit(1)))
            match = match.bitwiseOR(F.when(same, F.lit(1 << k)).otherwise(0).cast("long"))
        return F.struct(s.alias("s"), match.alias("eq"), j.alias("j"))

    def step(s: Column, j: Column) -> Column:
        # A one-element array binds the column's match bits once; so do the later stages.
        bound = F.transform(F.array(column(s, j)), lambda c: F.struct(
            c["s"].alias("s"), c["j"].alias("j"),
            (c["eq"].bitwiseAND(c["s"]["vp"]) + c["s"]["vp"]).bitwiseXOR(c["s"]["vp"]).bitwiseOR(c["eq"]).bitwiseOR(c["s"]["vn"])
            .bitwiseAND(F.lit(full)).alias("d0")))
        flow = F.transform(bound, lambda c: F.struct(
            c["s"]["d"].alias("d"), c["j"].alias("j"), c["d0"].alias("d0"),
            c["s"]["vn"].bitwiseOR(F.bitwise_not(c["d0"].bitwiseOR(c["s"]["vp"])).bitwiseAND(F.lit(full))).alias("hp"),
            c["d0"].bitwiseAND(c["s"]["vp"]).alias("hn")))

        def close(c: Column) -> Column:
            down = F.shiftright(c["d0"], 1)
            edge = n - tau  # columns before it move down the lower edge of the band
            # The last row sits one bit lower with every column after that; a column past the band has no such bit.
            last = F.greatest(F.lit(width - 2) - (c["j"] - edge), F.lit(0)).cast("int")
            bit = lambda word: F.call_function("shiftright", word, last).bitwiseAND(F.lit(1)).cast("int")
            moved = F.when(c["j"] < edge, 1 - F.shiftright(c["d0"], width - 1).cast("int")).otherwise(bit(c["hp"]) - bit(c["hn"]))
            return F.struct(
                c["hn"].bitwiseOR(F.bitwise_not(down.bitwiseOR(c["hp"])).bitwiseAND(F.lit(full))).alias("vp"),
                down.bitwiseAND(c["hp"]).alias("vn"), (c["d"] + moved).alias("d"))

        return F.get(F.transform(flow, close), F.lit(0))

    found = F.aggregate(F.sequence(F.lit(0), m - 1), state, step, lambda s: s["d"])
    return F.when(F.abs(n - m) > tau, F.lit(tau + 1)).when((n <= tau) | (m <= tau), F.levenshtein(a, b)).otherwise(found)


def occurrences(documents: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of every line with a word, spaces around it cut off; rows without id or text have none."""
    rows = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.withColumn("line", F.trim("line")).where(F.col("line").rlike(WORD))


def signature(line: Column) -> Column:
    """64 bits: for every hash value of a character, whether the line holds an odd number of them.  An edit changes two at most."""
    one = F.lit(1).cast("long")
    return F.aggregate(F.split(line, ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseXOR(
        F.call_function("shiftleft", one, F.pmod(F.xxhash64(c), F.lit(64)).cast("int"))))


def _hashes(line: str = "line") -> list[Column]:
    return [F.xxhash64(line).alias("h"), F.xxhash64(line, F.lit(1)).alias("g")]


def _first(rows: DataFrame, *keys: str) -> DataFrame:
    """The first (doc_id, line_no) of each key, kept in a decimal so that the sums stay hash-based."""
    order = F.col("doc_id").cast("decimal(20,0)") * F.lit(_SHIFT).cast("decimal(12,0)") + F.col("line_no").cast("decimal(12,0)")
    out = rows.groupBy(*keys).agg(F.min(order).alias("first"))
    doc = F.floor(F.col("first") / F.lit(_SHIFT).cast("decimal(12,0)")).cast("long")
    no = (F.col("first") - F.floor(F.col("first") / F.lit(_SHIFT).cast("decimal(12,0)")) * F.lit(_SHIFT).cast("decimal(12,0)")).cast("int")
    return out.select(*keys, doc.alias("doc_id"), no.alias("line_no"))


def near_links(documents: DataFrame, tau: int = TAU, edit_from: int = EDIT_FROM) -> DataFrame:
    """(h, g, near_doc, near_line, distance): each distinct line of at least ``edit_from`` characters, by its hashes, and the first place of every
    distinct line within ``tau`` edits that stands earlier (in an earlier place, or in the same one with a smaller hash)."""
    if edit_from < (tau + 1) ** 2:
        raise ValueError(f"{tau} edits need lines of at least {(tau + 1) ** 2} characters")
    distinct = _first(occurrences(documents).where(F.length("line") >= edit_from), "line").withColumn("n", F.length("line"))
    place = ["doc_id", "line_no", "h"]
    keys = distinct.select(*place[:2], F.xxhash64("line").alias("h"), F.explode(segment_keys(F.col("line"), F.col("n"), tau)).alias("key"))
    # Distinct lines: a key's rows are as many lines, so two or more are candidates.
    shared = keys.withColumn("many", F.count("*").over(Window.partitionBy("key"))).where("many > 1").drop("many")
    shared = materialize(shared, "segments")
    wanted = materialize(shared.select(*place).distinct(), "wanted")
    ids = materialize(wanted.select("doc_id").distinct(), "wanted-documents")
    # Sent to the texts while they are few; otherwise both sides are shuffled.
    ids = F.broadcast(ids) if ids.count() <= MOST_SENT else ids
    texts = documents.withColumn("doc_id", F.col("doc_id").cast("long")).join(ids, "doc_id", "left_semi")
    # Two documents may share an id; the hash tells their lines apart.
    lines = occurrences(texts).withColumns({"h": _hashes()[0], "g": _hashes()[1]}).join(wanted, place).distinct()
    lines = lines.select(*place, "g", "line", F.length("line").alias("n"), signature(F.col("line")).alias("bits"))
    full = materialize(shared.join(lines, place), "candidates")
    b = full.select("key", *[F.col(c).alias(f"b_{c}") for c in full.columns if c not in ("key", "g")])
    same = F.col("b_doc_id") == F.col("doc_id")
    earlier = (F.col("b_doc_id") < F.col("doc_id")) | (same & (F.col("b_line_no") < F.col("line_no"))) | (
        same & (F.col("b_line_no") == F.col("line_no")) & (F.col("b_h") < F.col("h")))
    # Part of the join, cheapest first, so that pairs ruled out are never rows: the signatures alone let millions of
    # pairs of one hot family of lines pass that are three or more edits apart.
    may = (F.abs(F.col("n") - F.col("b_n")) <= tau) & (F.bit_count(F.col("bits").bitwiseXOR(F.col("b_bits"))) <= 2 * tau)
    may = may & (F.levenshtein("line", "b_line", tau) >= 0)
    pairs = full.join(b, "key").where(earlier & may).select("h", "g", "b_doc_id", "b_line_no", "line", "b_line").distinct()
    # Written before the recurrence, which Spark would else run on every pair of a key as a filter over the join,
    # and again behind it, so that it runs once a pair; spread, as its work is much for few bytes.
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = materialize(pairs, "line-pairs").repartition(parts)
    measured = materialize(pairs.withColumn("distance", banded_distance(F.col("line"), F.col("b_line"), tau)).drop("line", "b_line"), "distances")
    found = measured.where(F.col("distance").between(1, tau))
    return found.select("h", "g", F.col("b_doc_id").alias("near_doc"), F.col("b_line_no").alias("near_line"), "distance")


def line_verdicts(documents: DataFrame, tau: int = TAU, edit_from: int = EDIT_FROM) -> DataFrame:
    """doc_id, line_no, kept, first_doc, first_line, distance and ``h`` (the line's hash) of every line with a word.

    The first place of a line is the smallest (doc_id, line_no) of an equal line
    or, from ``edit_from`` characters on, of one within ``tau`` edits of it; only the line that stands there itself is kept.  Lines are equal by 128 bits of hash.
    Rows of one id and text are one document; different texts under one id are judged each by its own lines.
    """
    links = materialize(near_links(documents, tau, edit_from), "near-lines")
    nearest = links.groupBy("h", "g").agg(F.min(F.struct(F.col("near_doc").alias("d"), F.col("near_line").alias("n"), "distance")).alias("p"))
    places = materialize(occurrences(documents).select("doc_id", "line_no", *_hashes()), "places")
    firsts = _first(places, "h", "g").withColumnsRenamed({"doc_id": "f_doc", "line_no": "f_line"})
    origin = firsts.join(nearest, ["h", "g"], "left").select(
        "h", "g", F.col("p").isNull().alias("own"), F.coalesce("p.d", "f_doc").alias("first_doc"), F.coalesce("p.n", "f_line").alias("first_line"),
        F.coalesce("p.distance", F.lit(0)).alias("distance"))
    kept = F.col("own") & (F.col("doc_id") == F.col("first_doc")) & (F.col("line_no") == F.col("first_line"))
    return places.join(origin, ["h", "g"]).select("doc_id", "line_no", kept.alias("kept"), "first_doc", "first_line", "distance", "h")


def drop_lines(documents: DataFrame, tau: int = TAU, edit_from: int = EDIT_FROM, spare: int = 0) -> DataFrame:
    """``documents`` without the lines that are not kept; ``n_chars`` follows the text.

    Lines of fewer than ``spare`` characters stay wherever they repeat; by default there are none.
    A row of which no line with a word is left goes; so a copy of a whole document goes with
    its last line.  Rows that lose nothing stay as they are, also empty and null texts and rows without id.
    """
    gone = line_verdicts(documents, tau, edit_from).where("NOT kept").groupBy("doc_id").agg(
        F.collect_set(F.struct("line_no", "h")).alias("__gone")).withColumnRenamed("doc_id", "__id")
    rows = documents.join(gone, F.col("doc_id") == F.col("__id"), "left")
    # The hash tells apart documents that share an id.
    numbered = F.transform(F.split("text", "\n", -1), lambda s, i: F.struct(i.alias("line_no"), F.xxhash64(F.trim(s)).alias("h"), s.alias("s")))
    stay = F.filter(numbered, lambda r: (F.length(F.trim(r["s"])) < spare) | ~F.array_contains(F.col("__gone"), F.struct(r["line_no"], r["h"])))
    left = F.array_join(F.transform(stay, lambda r: r["s"]), "\n")
    hit = F.col("__gone").isNotNull() & F.col("text").isNotNull()
    out = rows.withColumn("__left", F.when(hit, left))
    lost = F.coalesce(F.length("__left") < F.length("text"), F.lit(False))
    out = out.where(~(lost & ~F.coalesce(F.col("__left").rlike(WORD), F.lit(True))))
    changed = {"text": F.when(lost, F.col("__left")).otherwise(F.col("text"))}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        changed["n_chars"] = F.when(lost, F.length("__left").cast(kind)).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*documents.columns)
