"""What the third round of findings showed: the same answers from fewer rows, less memory and less disk."""

import re

import numpy as np
import pytest

from tessera import catalog_more, catalog_repair
from tessera.llm.shingles import partnered
from tessera.llm.vectors import near_duplicates
from tessera.sources import layers
from tests.llm import test_vectors


def test_postings_without_a_possible_partner_stay_at_home():
    rng = np.random.default_rng(5)
    rows = sorted((t, n, int(rng.integers(0, max(1, n // 7)))) for t in range(40) for n in rng.integers(1, 90, int(rng.integers(1, 40))).tolist())
    token, size, pos = (np.array(c, np.int64) for c in zip(*rows, strict=True))

    def may_link(i, j):
        need = -(-85 * (size[i] + size[j]) // 185)
        return i != j and token[i] == token[j] and min(size[i] - pos[i], size[j] - pos[j]) >= need

    want = [any(may_link(i, j) for j in range(len(rows))) for i in range(len(rows))]
    assert partnered(token.astype(np.uint64), size, pos, 85).tolist() == want and 0 < sum(want) < len(want)
    assert not len(partnered(token[:0], size[:0], pos[:0], 85))


@pytest.mark.parametrize("query", [catalog_repair.merge_candidates, catalog_more.merged_block_edges])
def test_what_grows_with_the_mesh_is_not_broadcast(spark, sf_dir, query):
    plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    small = re.compile(r"\[(block|part__)#")  # a row for each block or partition
    assert [line for line in plan.split("\n") if "BroadcastHashJoin" in line and not small.search(line)] == []


def test_crossings_are_counted_where_pieces_meet_sides(spark):
    square = [(0.0, 0.0), (90.0, 0.0), (90.0, 90.0), (0.0, 90.0)]
    hole = [(30.0, 30.0), (30.0, 60.0), (60.0, 60.0), (60.0, 30.0)]
    domain = spark.createDataFrame([(1, square, [hole])], "polygon long, ring array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>")
    seg = spark.createDataFrame([(1, 0, -9.0, 45.0, 99.0, 45.0), (2, 0, 10.0, -50.0, 10.0, -5.0)], "line long, i int, ax double, ay double, bx double, by double")
    got = layers.clipped_segments(seg, domain, 32.0)
    assert sorted((r.line, r.x0, r.x1) for r in got.collect()) == [(1, pytest.approx(0), pytest.approx(30)), (1, pytest.approx(60), pytest.approx(90))]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Aggregate [" in line and "t0#" in line]  # a row for each side met would be shuffled


def test_near_duplicates_are_the_same_in_many_rounds(spark):
    t = spark.createDataFrame(test_vectors.rows(), test_vectors.SCHEMA)
    one, many = ({tuple(r) for r in near_duplicates(t, list_rows=20, block_rows=32, sample_rows=100, round_rows=n).collect()} for n in (1_000_000, 1))
    assert one == many and len({r[2] for r in one}) < len(one)
