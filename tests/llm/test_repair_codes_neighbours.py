"""Conversation repair, vector codes and nearest neighbours against brute force and SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicator_engine.llm import conversation_repair as cr
from indicator_engine.llm import neighbours as nn
from indicator_engine.llm import vector_codes as vc
from indicator_engine.llm.queries import ORACLE, QUERIES
from tests.oracle_compare import connect, spark_rows, sql_rows


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_vector_codes"])
def test_matches_sql(spark, medium, name):
    columns, rows, _ = spark_rows(QUERIES[name](spark, medium))
    sql_columns, expected, _ = sql_rows(connect(medium), ORACLE[name])
    assert columns == sql_columns and sum(rows.values()) > 0
    assert rows == expected


# ---- conversation repair -------------------------------------------------------

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FOLLOWS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (conv, turn, "user" if fault == 4 else role, text)
        out += [row] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def judged(rows):
    """Rows of a conversation in order, each with its fault."""
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2])))
    seen, out = set(), []
    for turn, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def cheapest(rows):
    """Least (cost, initials) forward over all ways, with the rows that result."""
    best = {"": (0, "", ())}

    def offer(to, state, way):
        if state not in to or way[:2] < to[state][:2]:
            to[state] = way

    def with_inserts(ways):
        for _ in range(3):
            for state, (cost, edits, made) in list(ways.items()):
                role = {"u": "user", "a": "assistant"}[NEXT[state]]
                offer(ways, NEXT[state], (cost + 5, edits + "I", (*made, f"{role}:")))
        return ways

    for _, role, text, fault in rows:
        after = {}
        for state, (cost, edits, made) in with_inserts(best).items():
            offer(after, state, (cost + 2, edits + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if (state, role[:1]) in FOLLOWS:
                offer(after, role[0], (cost + more, edits + "K", (*made, f"{role}:{text}")))
            new = {"u": "user", "a": "assistant"}[NEXT[state]]
            offer(after, NEXT[state], (cost + more + 1, edits + "R", (*made, f"{new}:{text}")))
        best = after
    ended = [way for state, way in with_inserts(best).items() if state in ("", "a")]
    return min(ended, key=lambda way: way[:2])


def brute_audit(rows):
    out = []
    left = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = judged([r[1:] for r in left if r[0] == conv])
        turns = {t for t, *_ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults = Counter(fault for *_, fault in own)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        cost, edits, made = cheapest(own)
        digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, edits, digest))
    return Counter(out)


def conversations(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "usher", "S"]
    texts = ["Yes.", "No!", "what", "", " \n", "Why? \t", None, "a. ", "Hm. ", "x ", "é…"]
    rows = [(7, None, None, None), (7, None, "user", "Hi."), (8, 1, "user", "Hi."), (8, 1, "user", "Hi."), (None, 3, "user", "?")]
    rows += [(9, 2, "assistant", "b."), (9, 2, "assistant", "a."), (9, 2, "user", "a."), (10, 1, "system", "s." * 40_000)]
    for conv in range(20, 120):
        turn = rng.randrange(-3, 4)
        for _ in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(roles[:2] * 4 + roles), rng.choice(texts)))
            turn += rng.choice([0, 1, 1, 1, 1, 2, 5])
    for turn in range(700):  # a conversation that holds most rows
        role = "user" if turn % 2 == 0 else "assistant"
        rows.append((5, turn, rng.choice([role] * 6 + roles), rng.choice([f"t{turn}.", f"t{turn}!", f"t{turn}", *texts])))
    return rows


@pytest.mark.parametrize("least_block, parts", [(64, None), (1, 3)])
def test_repair_equals_brute_force(spark, monkeypatch, least_block, parts):
    monkeypatch.setattr(cr, "LEAST_BLOCK", least_block)
    if parts:  # order cut in places of its own
        monkeypatch.setattr(cr, "parts_for", lambda *_: parts)
    rows = conversations(least_block)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    taken = ("_at", "_conv", "edit", "copies", "digest", "state", "_copies", "block", "audit")
    got = cr.audit(spark, frame.withColumns({c: F.lit("x") for c in taken}))
    assert Counter(map(tuple, got.collect())) == brute_audit(rows)


def test_repair_without_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.audit(spark, empty).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.")], empty.schema)
    assert [tuple(r) for r in cr.audit(spark, frame).collect()] == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    ]


def test_repaired_rows_and_edits(spark):
    """The operator on rows without damage: whole texts, rows put in, a repeated row counted."""
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 1, "user", "Hi?"), (1, 2, "user", "Well?"), (2, 0, "assistant", "Yes.")]
    done = cr.repair(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    made = [(r._conv, r.role, r.text) for r in done.rows.orderBy("_conv", "_at", "_step").collect()]
    assert made == [("=1", "system", "Be kind."), ("=1", "user", "Hi?"), ("=1", "assistant", "Well?")]
    edits = [(r.edit + r.tail, r.copies, r.fault) for r in done.edits.orderBy("_at").collect()]
    assert edits == [("K", 1, None), ("K", 2, None), ("A", 1, None), ("D", 1, None)]


# ---- vector codes ----------------------------------------------------------------


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_codes(rows, parts, entries, rounds):
    kept = sorted((r for r in rows if usable(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = -(-max(len(v) for _, v, _ in kept) // parts)
    whole = [[math.floor(256 * x) for x in v] + [0] * (parts * size - len(v)) for _, v, _ in kept]
    cut = [[tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    choose = lambda part, book: min((far(part, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            taken = [choose(c[p], book)[1] for c in cut]
            for i in set(taken):
                own = [c[p] for c, t in zip(cut, taken) if t == i]
                book[i] = tuple(sum(xs) // len(own) for xs in zip(*own))
    chosen = [[choose(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in c) for c in chosen]
    by_label = Counter()
    for (_, _, label), error in zip(kept, errors):
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter(
        (i, "".join(f"{e:02x}" for _, e in c), error, by_label[label], digest)
        for (i, _, label), c, error in zip(kept, chosen, errors)
    )


def vectors(n, width, seed=3):
    rng = np.random.default_rng(seed)
    single = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, single(rng.normal(0, 0.4, width).round(2)), [1, 1, 2, None][i % 4]) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [1.0, None], 1), (n + 2, [float("nan")], 1), (n + 3, [float("inf")] * 3, 1)]
    rows += [(3, rows[3][1], 2), (3, rows[4][1], 2), (None, rows[5][1], 9), (n + 4, [], 1), (n + 5, single([0.5, -2.25]), None)]
    return rows + [(n + 10 + i, rows[0][1], 2) for i in range(30)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("subtree, chunk, width, n", [(4096, 1 << 22, 32, 150), (3, 400, 35, 90), (2, 64, 16, 40)])
def test_codes_equal_brute_force(spark, monkeypatch, subtree, chunk, width, n):
    monkeypatch.setattr(vc, "SUBTREE", subtree)
    monkeypatch.setattr(vc, "CHUNK_VALUES", chunk)
    rows = vectors(n, width)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = frame.withColumns({c: F.lit("x") for c in ("code", "error", "_v", "_label", "label_error")})
    got = vc.compress(spark, frame)
    assert Counter(map(tuple, got.collect())) == brute_codes(rows, 16, 64, 2)
    assert vc.compress(spark, frame.where("false")).count() == 0
    assert vc.compress(spark, frame.where(f"vec_id = {n}")).count() == 0


def test_codes_decode_to_entries(spark):
    frame = spark.createDataFrame(vectors(120, 32), SCHEMA)
    books = vc.learn(frame, parts=8, entries=10, rounds=1)
    back = vc.decode(vc.encode(frame, books, ["vec_id", "embedding"]), books).collect()
    assert len(back) > 120
    for r in back:
        own = np.floor(np.array([*r.embedding, *[0.0] * (32 - len(r.embedding))], np.float64) * 256)
        assert int(((own - np.array(r.approximate) * 256) ** 2).sum()) == r.error


def test_trie_shares_prefixes_and_ties_go_to_the_first():
    book = np.array([[0, 0], [2, 0], [2, 0]])
    entry, distance = vc.nearest(np.array([[0, 0], [1, 0], [1, 5], [2, -1]]), book)
    assert entry.tolist() == [0, 0, 0, 1] and distance.tolist() == [0, 1, 26, 1]


# ---- nearest neighbours --------------------------------------------------------------


def brute_neighbours(rows, every, k):
    good = [(i, v) for i, v, _ in rows if i is not None and usable(v) and any(v)]
    width = max(len(v) for _, v in good)
    filled = {}
    for i, v in good:
        if i % every == 0:
            filled[i] = min(filled.get(i, v), v)
    ids = np.array([i for i, _ in good])
    matrix = np.array([v + [0.0] * (width - len(v)) for _, v in good])
    out = {}
    for q, v in filled.items():
        scores = (matrix * np.array(v + [0.0] * (width - len(v)))).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def ranked(got):
    out = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("segment, block, cells", [(8192, 1024, 4096), (50, 7, 4096), (40, 3, 2)])
def test_sure_search_is_exact(spark, monkeypatch, segment, block, cells):
    for name, value in (("SEGMENT", segment), ("BLOCK", block), ("CELLS", cells), ("LEAF", 8)):
        monkeypatch.setattr(nn, name, value)
    rows = [*vectors(400, 12), (2000, [0.0] * 12, 1), (2020, [1.0, -1.0], 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in ("_id", "score", "rank")})
    got = nn.nearest(spark, frame, frame.where("vec_id % 20 = 0"), sure=1 - 1e-12)
    assert ranked(got) == brute_neighbours(rows, 20, 20)
    assert nn.nearest(spark, frame.where("false"), frame).count() == 0
    assert nn.nearest(spark, frame, frame.where("false")).count() == 0
    few = frame.where("vec_id in (20, 21, 22, 401)")
    assert [r.vec_id for r in nn.nearest(spark, few, few.where("vec_id = 20")).collect()].__len__() == 2


def test_recall(spark, monkeypatch):
    for name, value in (("SEGMENT", 500), ("BLOCK", 64), ("LEAF", 32)):
        monkeypatch.setattr(nn, name, value)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 48))
    points = np.concatenate([centres[rng.integers(0, 30, 2000)] + rng.normal(0, 0.7, (2000, 48)), rng.normal(size=(2000, 48))])
    points *= rng.uniform(0.5, 1.5, len(points))[:, None]
    rows = [(i, [float(x) for x in v.astype(np.float32)], 0) for i, v in enumerate(points)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got, true = ranked(nn.nearest(spark, frame, frame.where("vec_id % 20 = 0"))), brute_neighbours(rows, 20, 20)
    assert got.keys() == true.keys()
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in true[q]}) for q in true)
    assert found / (20 * len(true)) >= 0.95


def test_recall_of_the_registered_query(spark, medium):
    table = spark.read.parquet(f"{medium}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, r.label) for r in table]
    got, true = ranked(QUERIES["op13_neighbours"](spark, medium)), brute_neighbours(rows, 20, 20)
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in true[q]}) for q in true)
    assert got.keys() == true.keys() and found / sum(map(len, true.values())) >= 0.9


def test_chi_square():
    assert nn.chi_square_at(0.95, 2) == pytest.approx(5.9915, abs=1e-4)
    assert nn.chi_square_at(0.95, 12) == pytest.approx(21.0261, abs=1e-4)


def test_equal_points_make_one_leaf():
    tree = nn.Tree(np.ones((50, 3)), 4)
    assert tree.starts == [0] and (tree.leaf_of(np.zeros((2, 3))) == 0).all()
