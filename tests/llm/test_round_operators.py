"""Centroid clusters, conversation repair and WARC archives: against brute force and odd rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from shelfwise.llm import conversations, vector_clusters, warc
from shelfwise.llm.common import Scratch, small_batches

# --- clusters


def plain_nearest(centroids, vectors):
    away = ((vectors[:, None, :] - centroids[None, :, :]) ** 2).sum(2)
    return away.argmin(1), away.min(1)


def plain_rounds(rows, dims, scale, k, rounds):
    kept = []
    for key, v in rows:
        if v is None or len(v) != dims or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((key, [int(np.floor(scale * float(x))) for x in v]))
    starts = sorted((hashlib.sha256(f"1:{key}".encode()).hexdigest(), v) for key, v in kept if key is not None)[:k]
    centroids = np.array([v for _, v in starts], np.int64).reshape(-1, dims)
    vectors = np.array([v for _, v in kept], np.int64).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        number, _ = plain_nearest(centroids, vectors)
        for c in set(number.tolist()):
            own = vectors[number == c]
            centroids[c] = [int(s) // len(own) for s in own.sum(0)]
    if not len(centroids):
        return [], centroids
    number, away = plain_nearest(centroids, vectors)
    return [(key, int(n), int(d)) for (key, _), n, d in zip(kept, number, away, strict=True)], centroids


@pytest.mark.parametrize("k", [1, 2, 5, 16, 100])
def test_tree_finds_the_nearest_and_the_smallest_of_ties(k):
    rng = np.random.default_rng(k)
    for high in (2, 5, 1000, vector_clusters.LARGEST):
        centroids = rng.integers(-high, high, (k, 3))
        centroids[k // 2] = centroids[0]  # equal centroids tie everywhere
        vectors = np.vstack([rng.integers(-high, high, (300, 3)), centroids])
        number, away = vector_clusters.Tree.build(centroids).nearest(vectors)
        want = plain_nearest(centroids, vectors)
        assert (number == want[0]).all() and (away == want[1]).all()


def test_tree_skips_far_centroids():
    """Clusters far apart: most centroids are never looked at."""
    rng = np.random.default_rng(1)
    centroids = rng.integers(-(10**6), 10**6, (200, 2))
    looked, plain = [], vector_clusters.squared
    vector_clusters.squared = lambda a, b: looked.append(len(a)) or plain(a, b)
    try:
        tree = vector_clusters.Tree.build(centroids)
        looked.clear()
        tree.nearest(centroids + rng.integers(-3, 3, centroids.shape))
    finally:
        vector_clusters.squared = plain
    assert sum(looked) < 0.25 * len(centroids) ** 2


def test_clusters_of_odd_rows(spark):
    small_batches(spark)
    rng = random.Random(4)
    rows = [(i % 90, [rng.uniform(-2, 2) for _ in range(4)]) for i in range(150)]  # ids repeat
    rows += [(200 + i, [0.25, 0.5, -0.25, 0.0]) for i in range(60)]  # one hot group of copies
    nan = float("nan")
    rows += [(300, None), (301, []), (302, [1.0] * 5), (303, [1.0, None, 0.0, 0.0]), (304, [nan, 0.0, 0.0, 0.0]),
             (305, [float("inf"), 0.0, 0.0, 0.0]), (306, [1e30, 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, 9, 9) for r in rows], "vec_id long, embedding array<double>, cluster int, whole int")
    found = vector_clusters.cluster_vectors(df, Scratch(spark, "t"), dims=4, scale=8, k=6, rounds=3)
    want, centroids = plain_rounds([r for r in rows if r[0] != 306], 4, 8, 6, 3)
    got = [tuple(r) for r in found.assigned.collect()]
    assert (found.centroids == centroids).all() and sorted(got, key=str) == sorted(want, key=str)
    per = {r["cluster"]: r for r in vector_clusters.with_inertia(found).collect()}
    assert {c: r["cluster_inertia"] for c, r in per.items()} == {c: sum(w[2] for w in want if w[1] == c) for c in per}
    assert all(r["inertia"] == sum(w[2] for w in want) for r in per.values())
    text = {c: ",".join(map(str, centroids[c])) for c in per}
    assert all(r["centroid_sha256"] == hashlib.sha256(text[c].encode()).hexdigest() for c, r in per.items())
    few = vector_clusters.cluster_vectors(df.where("vec_id = 200"), Scratch(spark, "t"), dims=4, k=6)
    assert [tuple(r) for r in few.assigned.collect()] == [(200, 0, 0)]
    for none in (df.limit(0), df.where("vec_id = 300")):
        empty = vector_clusters.with_inertia(vector_clusters.cluster_vectors(none, Scratch(spark, "t"), dims=4))
        assert empty.collect() == [] and "centroid_sha256" in empty.columns


# --- conversations

GRAMMAR = ["", *("s" * odd + "ua" * pairs for pairs in range(1, 9) for odd in (0, 1))]


def plain_cheapest(letters):
    """Least (cost, audit) over the full table of every target."""
    best = None
    for target in GRAMMAR:
        table = {}
        for i in range(len(letters), -1, -1):
            for j in range(len(target), -1, -1):
                ways = [(0, "")] if i == len(letters) and j == len(target) else []
                if i < len(letters):
                    c, a = table[i + 1, j]
                    ways.append((c + 2, "D" + a))
                if j < len(target) and target[j] != "s":
                    c, a = table[i, j + 1]
                    ways.append((c + 5, "I" + a))
                if i < len(letters) and j < len(target) and letters[i] != "-":
                    c, a = table[i + 1, j + 1]
                    own, extra = letters[i].lower(), 5 if letters[i].isupper() else 0
                    if own == target[j]:
                        ways.append((c + extra, "K" + a))
                    elif target[j] != "s":
                        ways.append((c + extra + 1, "R" + a))
                table[i, j] = min(ways) if ways else (10**9, "")
        best = min(x for x in (best, table[0, 0]) if x is not None)
    return best


def test_cheapest_repair_of_all_short_conversations():
    for n in range(4):
        for letters in itertools.product("suaxSUAX-", repeat=n):
            word = "".join(letters)
            assert conversations.aligned(word) == conversations.folded(word) == plain_cheapest(word), word
    rng = random.Random(7)
    for _ in range(400):
        word = "".join(rng.choices("suaxUAX-", [1, 9, 9, 1, 1, 1, 1, 2], k=rng.randrange(4, 13)))
        assert conversations.aligned(word) == conversations.folded(word) == plain_cheapest(word), word


def test_long_conversations_fold_to_the_same_audit():
    rng = random.Random(8)
    for n in (60, 300, 700):
        word = "".join(c if rng.random() > 0.2 else rng.choice("suaxUAX-") for c in ("s" + "ua" * n)[:n])
        assert conversations.aligned(word) == conversations.folded(word)
    assert conversations.cheapest("ua" * 50_000 + "-") == (2, "K" * 100_000 + "D")


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) of one conversation's rows in order."""
    letters, seen, counts = "", set(), dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
        bare = text.strip(" \t\n\v\f\r")
        if not bare:
            counts["blank"] += 1
            letter = "-"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            letter = "-"
        elif bare[-1] not in ".!?":
            counts["truncated"] += 1
            letter = letter.upper()
        seen.add((role, text))
        letters += letter
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit = conversations.cheapest(letters)
    kept, left = [], list(rows)
    target = next(t for t in GRAMMAR if len(t) == len(audit) - audit.count("D"))
    for edit in audit:
        if edit == "I":
            kept.append(({"u": "user", "a": "assistant"}[target[len(kept)]], ""))
            continue
        _, role, text = left.pop(0)
        if edit != "D":
            kept.append((role if edit == "K" else {"u": "user", "a": "assistant"}[target[len(kept)]], text))
    return (gaps, *counts.values(), illegal, cost, audit), kept


def test_repair_of_odd_rows(spark):
    small_batches(spark)
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 3, "assistant", "Yes!"), (1, 3, "assistant", "Yes!"), (1, 4, "user", "so"),
        (2, None, None, "Who?"), (2, None, "", "x."), (2, 5, "tool", " \t\n"), (2, -4, "user", "a?\n"), (2, 9, "assistant", None),
        (3, 1, "assistant", "B."), (3, 0, "assistant", "A."), (3, 2, "user", "C. " + "z" * 200_000 + "?"), (3, 2, "user", "D."),
        (None, None, "user", "q"), (None, None, "assistant", "r."), (4, 7, "system", "only."), (5, 1, "user", ""), (6, 1, "user", "never."),
    ]
    df = spark.createDataFrame([(*r, 1 - (r[0] == 6), "mine", 5) for r in rows],
                               "conv_id long, turn long, role string, text string, copies int, audit string, conv int")
    repair = conversations.Repair(df, Scratch(spark, "t"), copies_col="copies")
    audits = {r["conv"]: tuple(r)[1:] for r in repair.audits.collect()}
    turns, digests = {}, {r["conv"]: r["digest"] for r in repair.digests().collect()}
    for r in sorted(repair.turns().collect(), key=lambda r: r["place"]):
        turns.setdefault(r["conv"], []).append((r["role"], r["text"]))
    assert set(audits) == {1, 2, 3, 4, 5, 6, None} == set(digests)
    for conv in audits:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv and c != 6]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        want, kept = plain_repair(own)
        assert audits[conv] == want and turns.get(conv, []) == kept, conv
        assert digests[conv] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest()
    assert audits[6] == (0, 0, 0, 0, 0, 0, "") and audits[1][1:4] == (0, 1, 1)
    empty = conversations.Repair(df.limit(0), Scratch(spark, "t"))
    assert empty.audits.collect() == empty.turns().collect() == empty.digests().collect() == []


def test_one_conversation_of_many_batches(spark):
    """A conversation longer than the fold and than a batch, with hot repeats."""
    small_batches(spark)
    n = conversations.LONG + 700
    word = lambda i: "same." if i % 3 == 0 else f"t{i}."
    rows = [("c", i, "user" if i % 2 else "assistant", word(i)) for i in range(n)]
    repair = conversations.Repair(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"), Scratch(spark, "t"))
    want = repair.audits.first()
    assert want["duplicate"] == sum(i % 3 == 0 for i in range(n)) - 2 and len(want["audit"].replace("I", "")) == n
    assert repair.turns().count() == n + want["audit"].count("I") - want["audit"].count("D")


def test_damage_by_rule(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): tuple(r)[2:] for r in conversations.damaged(df).collect()}
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate <= 1 else text.translate({ord(x): None for x in ".!?"}) if fate == 2 else text
        assert got[c, t] == ("user" if fate == 4 else role, text, {0: 0, 3: 2}.get(fate, 1))


# --- archives


def plain_records(data):
    """(at, header, block) by walking an archive."""
    at, out = 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode()
        length = int(head.lower().split("content-length: ")[1].split("\r\n")[0])
        out.append((at, head, data[end + 4 : end + 4 + length]))
        assert data[end + 4 + length : end + 8 + length] == b"\r\n\r\n"
        at = end + 8 + length
    return out


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
PAYLOADS = [None, "", "x", "\r\n", "\r\n\r\n", "\n", "\r", "a\r\n", "a\r\n\r\n", "a\r\n\r", "a\r\n\r\n\r\n", "\r\n\r\n\r\nWARC/1.1\r\n", FAKE, FAKE * 3, "\r\n" + FAKE,
            "é漢\0\x01" + FAKE + "z" * 3000 + "\r\n", "y" * 999, "y" * 1000, "y" * 1000, "é" * 500, "é" * 500, "é" * 499, "é" * 499, "w" * 200_000]


def pages(spark, payloads=PAYLOADS):
    rows = [(i, f"http://h/{i}\r\nWARC-Type: x" if i % 2 else None, p, "mine", "mine") for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, key string, head string")


def test_archives_are_warc_and_come_back(spark, tmp_path):
    small_batches(spark)
    scratch = Scratch(spark, "t")
    warc.write_archives(pages(spark).repartition(3), f"{tmp_path}/a", scratch)
    files = {f"{p}": p.read_bytes() for p in (tmp_path / "a").glob("part-*")}
    want = {(at, name): (head, block) for name, data in files.items() for at, head, block in plain_records(data)}
    assert len(want) == len(PAYLOADS)
    back = warc.read_archives(spark, f"{tmp_path}/a", scratch).collect()
    got = {(r["at"], re.sub("^file:/+", "/", r["file"])): r for r in back}
    assert set(got) == set(want)
    by_id = {}
    for at, (head, block) in want.items():
        http, payload = block.split(b"\r\n\r\n", 1)
        row = got[at]
        assert bytes(row["payload"]) == payload and row["http"].encode() == http and f"WARC-Type: {row['record_type']}\r\n" in head
        by_id[int(row["record_id"].strip("<>").rsplit(":")[-1])] = row
    for i, text in enumerate(PAYLOADS):
        payload = (text or "").encode()
        last = max(j for j, p in enumerate(PAYLOADS) if (p or "") == (text or ""))
        row = by_id[i]
        revisit = len(payload) >= 1000 and last != i
        assert row["record_type"] == ("revisit" if revisit else "response")
        assert bytes(row["payload"]) == (b"" if revisit else payload) and row["digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
        assert row["refers_to"] == (f"<urn:x-page:{last}>" if revisit else None)
        assert f"Content-Length: {len(payload)}" in row["http"] and row["url"] == (f"http://h/{i}%0D%0AWARC-Type: x" if i % 2 else None)


def test_records_across_splits(spark, tmp_path):
    """Splits far smaller than a record, at every place of an archive."""
    small_batches(spark)
    rng = random.Random(3)
    texts = [rng.choice([FAKE, "a\r\n", "\r\n\r\n", "p" * rng.randrange(900), "", FAKE[:40] * 5]) for _ in range(12)]
    warc.write_archives(pages(spark, texts).coalesce(1), f"{tmp_path}/a", Scratch(spark, "t"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("110", "900"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            back = warc.read_archives(spark, f"{tmp_path}/a", Scratch(spark, "t")).collect()
            got = sorted((int(r["record_id"].strip("<>").rsplit(":")[-1]), bytes(r["payload"]).decode()) for r in back)
            assert got == list(enumerate(texts)), size
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_broken_and_empty_archives(spark, tmp_path):
    small_batches(spark)
    warc.write_archives(pages(spark).coalesce(1), f"{tmp_path}/a", Scratch(spark, "t"))
    data = next((tmp_path / "a").glob("part-*")).read_bytes()
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "cut.warc").write_bytes(data[:-5])
    with pytest.raises(ValueError, match="last byte"):
        warc.read_archives(spark, f"{tmp_path}/b", Scratch(spark, "t"))
    warc.write_archives(pages(spark).limit(0), f"{tmp_path}/c", Scratch(spark, "t"))
    assert warc.read_archives(spark, f"{tmp_path}/c", Scratch(spark, "t")).collect() == []


def test_ties_and_null_pages(spark):
    big = "b" * 1500
    rows = [(None, big), (4, big), (4, big), (2, big), (None, "c" * 1200), (None, "c" * 1200), (9, None), (9, "")]
    df = spark.createDataFrame([(i, None, p) for i, p in rows], "page_id long, url string, html string")
    got = sorted(((r["id"], len(r["payload"]), r["revisit"], r["refers_to"]) for r in warc.revisits(df, Scratch(spark, "t"), "page_id", "url", "html").collect()), key=str)
    assert got == sorted(
        [(None, 1500, True, 4), (4, 1500, False, None), (4, 1500, False, None), (2, 1500, True, 4),
         (None, 1200, False, None), (None, 1200, False, None), (9, 0, False, None), (9, 0, False, None)], key=str)


def test_jumps_keep_only_what_the_start_reaches(spark):
    """Random candidate graphs, against a walk."""
    rng = random.Random(6)
    links, want = [], set()
    for file in "abc":
        at = sorted(rng.sample(range(1, 500), 120)) if file != "c" else []
        spots = [0, *at]
        to = {a: rng.choice([b for b in spots if b > a][:4] or [999]) for a in spots}
        links += [(file, a, b) for a, b in to.items()]
        now = 0
        while now in to:
            want.add((file, now))
            now = to[now]
    links += [("b", 777, None), ("b", 778, 5)]
    df = spark.createDataFrame(links, "file string, at long, next long")
    assert {tuple(r) for r in warc.reached(df, Scratch(spark, "t")).collect()} == want


def test_exits_of_a_split():
    """Chains inside a split, against a walk."""
    rng = random.Random(9)
    for _ in range(200):
        at = sorted(rng.sample(range(400), 30))
        found = []
        for a in at:
            start = a + rng.randrange(20, 30)
            length = rng.choice([None, *[max(b - start - 4, 0) for b in at if b > start + 4][:3], rng.randrange(900)])
            found.append((a, start, length))
        by = {a: (s, n) for a, s, n in found}
        got = {row[0]: row[1:] for row in warc.exits(found, 450)}
        assert set(got) == set(at)
        for a in at:
            now, want = a, (None,) * 4
            while now in by and by[now][1] is not None:
                start, length = by[now]
                if start + length + 4 >= 446:
                    want = (start + length + 4, now, start, start + length)
                    break
                now = start + length + 4
            assert got[a] == want


def test_records_in_shuffled_splits(spark, tmp_path, monkeypatch):
    """The way for more splits than are broadcast gives the same records."""
    small_batches(spark)
    warc.write_archives(pages(spark).repartition(2), f"{tmp_path}/a", Scratch(spark, "t"))
    monkeypatch.setattr(warc, "BROADCAST_SPLITS", 0)
    back = warc.read_archives(spark, f"{tmp_path}/a", Scratch(spark, "t")).collect()
    payloads = {int(r["record_id"].strip("<>").rsplit(":")[-1]): bytes(r["payload"]).decode() for r in back if r["record_type"] == "response"}
    assert len(back) == len(PAYLOADS) and all(payloads[i] == (PAYLOADS[i] or "") for i in payloads)
