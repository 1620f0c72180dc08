"""Codes of vectors against a plain loop over Python's numbers."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from telemetra.llm import queries, vector_codes

SCHEMA = "vec_id LONG, embedding ARRAY<DOUBLE>, label STRING, code INT, error STRING"


def by_loop(rows, parts, entries, rounds, scale=4096):
    usable = [(i, v) for i, v, *_ in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in usable if len(v) == len(usable[0][1])]
    width = len(whole[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        nearest = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, n in zip(cut, nearest) if n[p][1] == k]
                if mine:
                    books[p][k] = [sum(xs) // len(mine) for xs in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{k:02x}" for _, k in n), sum(d for d, _ in n)) for (i, _), n in zip(whole, assign())), digest


def coded(spark, rows, **settings):
    vectors = spark.createDataFrame([(*r, 7, "e") for r in rows], SCHEMA)
    books = vector_codes.train(vectors, **settings)
    found = vector_codes.encode(vectors, books, keep=["vec_id", "label"])
    assert found.columns == ["vec_id", "label", "code", "error"]
    return sorted((str(r["vec_id"]), r["code"], r["error"]) for r in found.collect()), books.sha256()


def some_rows(n, width, size, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, size) for _ in range(width)], "l") for i in range(n)]
    rows += [(i, [float(rng.randrange(-2, 3)) / 4096 for _ in range(width)], None) for i in range(n, n + 40)]  # many ties
    return rows


def test_against_loop(spark):
    rows = some_rows(160, 8, 0.2, 1)
    odd = [(500, None, "l"), (501, [], "l"), (502, [None] * 8, "l"), (503, [0.0] * 7 + [math.nan], "l"), (504, [math.inf] * 8, "l"), (505, [0.5] * 4, "l")]
    rows += odd + rows[:3] + [(None, [0.25] * 8, "l"), (0, [-9.0] * 8, "l")]
    assert coded(spark, rows, parts=4, entries=5, rounds=3) == by_loop(rows, 4, 5, 3)


def test_large_numbers(spark):
    rows = [*some_rows(30, 4, 1.0, 2), (900, [1e6, -1e6, 3.7e5, 2.0**40], "l"), (901, [1e-300, -1e-300, 2.0**17 + 0.1, -0.0], "l")]
    assert coded(spark, rows, parts=2, entries=3, rounds=2) == by_loop(rows, 2, 3, 2)
    with pytest.raises(Exception, match="too large"):
        coded(spark, [(1, [1e200, 0.0], "l"), (2, [0.0, 0.0], "l")], parts=2, entries=1, rounds=0)


def test_few_and_no_vectors(spark):
    rows = [(2, [0.1, 0.2], "l"), (1, [0.1, 0.2], None)]
    assert coded(spark, rows, parts=2, entries=16, rounds=6) == by_loop(rows, 2, 16, 6)
    assert coded(spark, [(1, None, "l")])[0] == []
    with pytest.raises(ValueError, match="divide"):
        coded(spark, [(1, [1.0, 2.0, 3.0], "l")], parts=2)


@pytest.mark.parametrize("spread", [3, 40, 4000])
def test_cells_rule_out_only_what_is_further(spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread, (1, 16, 3))
    values = rng.integers(-2 * spread, 2 * spread, (3000, 3))
    cells = vector_codes.Cells(entries)
    index, error = cells.nearest(0, values)
    apart = ((values[:, None, :] - entries[0]) ** 2).sum(axis=2)
    assert (index == apart.argmin(axis=1)).all() and (error == apart.min(axis=1)).all()
    again, _ = cells.nearest(0, values[::-1].copy())  # from memory
    assert (again[::-1] == index).all()
    assert np.mean([sum(m) for m in cells.met[0].values()]) < 8  # most entries are never compared


def test_forgetting_changes_nothing(monkeypatch):
    rng = np.random.default_rng(0)
    entries, values = rng.integers(-50, 50, (1, 8, 2)), rng.integers(-99, 99, (500, 2))
    whole = vector_codes.Cells(entries).nearest(0, values)[0]
    monkeypatch.setattr(vector_codes, "REMEMBERED", 4)
    cells = vector_codes.Cells(entries)
    assert (np.concatenate([cells.nearest(0, values[i : i + 7])[0] for i in range(0, 500, 7)]) == whole).all()


def test_labels_in_query(spark, tmp_path):
    rows = [(i, [float(np.sin(i * j)) for j in range(1, 9)], [None, "a", "b"][i % 3], 1, "x") for i in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.QUERIES["op12_vector_codes"](spark, str(tmp_path)).collect()
    sums = {}
    for r in found:
        sums[r["vec_id"] % 3] = sums.get(r["vec_id"] % 3, 0) + r["error"]
    assert len(found) == 60 and all(r["label_error"] == sums[r["vec_id"] % 3] for r in found)
