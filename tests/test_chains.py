"""Chain files: points from query to target on both strands, and every broken line named."""

import pytest

from sorrel.operators import intervals
from sorrel.operators.contract import ContractError, RowError
from sorrel.sources import chains, readers

#: Two blocks with gaps, a reversed one, one place hit twice, and the contig's last base.
GOOD = """# comment
chain 100 chrA 40 + 0 12 chrA 40 + 0 11 1
4 2 1
6

chain 80 chrA 40 + 20 30 chrA 40 - 10 20 2
10

chain 60 chrA 40 + 14 15 chrA 40 + 14 15 3
1
chain 5e1 chrA 40 + 34 35 chrA 40 + 14 15 4
1

chain 40 chrA 40 + 39 40 chrA 40 + 39 40 5
1
"""


@pytest.fixture(scope="module")
def contigs(spark):
    return spark.createDataFrame([("chrA", 40)], "chr string, length long")


def read(spark, tmp_path, contigs, text, **limits):
    (tmp_path / "x.chain").write_text(text)
    return chains.chain_blocks(spark, str(tmp_path / "x.chain"), contigs, contigs, **limits)


def test_points_go_from_query_to_target(spark, tmp_path, contigs):
    blocks = read(spark, tmp_path, contigs, GOOD)
    points = spark.createDataFrame([(p, "chrA", p) for p in (1, 4, 5, 6, 8, 11, 12, 15, 18, 20, 21, 30, 31, 40)], "k long, chr string, pos long")
    hits = sorted((r.k, r.target_pos, r.strand, r.chain_id, r.chain_score, r.block_size) for r in intervals.map_points(points, blocks, "k").collect())
    assert hits == [
        (1, 1, "+", "1", 100.0, 4), (4, 4, "+", "1", 100.0, 4), (6, 7, "+", "1", 100.0, 6), (8, 9, "+", "1", 100.0, 6), (11, 12, "+", "1", 100.0, 6), (15, 15, "+", "3", 60.0, 1), (15, 35, "+", "4", 50.0, 1),
        (21, 30, "-", "2", 80.0, 10), (30, 21, "-", "2", 80.0, 10), (40, 40, "+", "5", 40.0, 1),
    ]


def test_reversed_blocks_of_a_gapped_chain(spark, tmp_path, contigs):
    """Every base of a reversed chain with gaps on both sides, against walking along it."""
    blocks = read(spark, tmp_path, contigs, "chain 1 chrA 40 + 3 15 chrA 40 - 5 16 x\n3 2 0\n2 0 1\n5\n")
    want, t, q = set(), 3, 5
    for size, dt, dq in ((3, 2, 0), (2, 0, 1), (5, 0, 0)):
        want |= {(40 - q - i, t + i + 1) for i in range(size)}
        t, q = t + size + dt, q + size + dq
    points = spark.range(1, 41).selectExpr("id as k", "'chrA' as chr", "id as pos")
    assert {(r.k, r.target_pos) for r in intervals.map_points(points, blocks, "k").collect()} == want


HEAD = "chain 100 chrA 40 + 0 12 chrA 40 + 0 11 1\n"


@pytest.mark.parametrize(
    ("text", "line", "reason"),
    [
        ("", None, "no chains"),
        ("# only comments\n\n", None, "no chains"),
        ("4 2 1\n" + HEAD + "4 2 1\n6\n", 1, "outside"),
        ("chain 100 chrA 40 + 0 12 chrA 40 + 0 11\n4 2 1\n6\n", 1, "13 fields"),
        (HEAD.replace("1\n", "1 x\n") + "4 2 1\n6\n", 1, "13 fields"),
        (HEAD.replace(" 12 ", " 12.0 ") + "4 2 1\n6\n", 1, "whole numbers"),
        (HEAD.replace("100", "nan") + "4 2 1\n6\n", 1, "score"),
        (HEAD.replace("100", "-1") + "4 2 1\n6\n", 1, "score"),
        (HEAD.replace("100", "1e999") + "4 2 1\n6\n", 1, "score"),
        (HEAD + "4 2 1\n6\n\n" + HEAD + "4 2 1\n6\n", 5, "earlier chain"),
        (HEAD.replace("40 + 0 12", "40 - 0 12") + "4 2 1\n6\n", 1, "strand"),
        (HEAD.replace("40 + 0 11", "40 * 0 11") + "4 2 1\n6\n", 1, "strand"),
        (HEAD.replace("chrA 40 + 0 12", "chrB 40 + 0 12") + "4 2 1\n6\n", 1, "contig"),
        (HEAD.replace("40 + 0 11", "41 + 0 11") + "4 2 1\n6\n", 1, "contig"),
        (HEAD.replace("0 12", "0 41") + "4 2 1\n6\n", 1, "within the contigs"),
        (HEAD.replace("0 11", "11 11") + "4 2 1\n6\n", 1, "within the contigs"),
        (HEAD + "4 2 1\n", 1, "no last block"),
        (HEAD, 1, "no last block"),
        (HEAD + HEAD.replace("1\n", "2\n").replace("0 12", "0 6") + "6\n", 1, "no last block"),
        (HEAD + "4 2 1\n6\n3\n", 4, "after the last"),
        (HEAD + "4 2\n6\n", 2, "one or three"),
        (HEAD + "4 2 1 0\n6\n", 2, "one or three"),
        (HEAD + "4 x 1\n6\n", 2, "whole numbers"),
        (HEAD + "0 2 1\n6\n", 2, "has a size"),
        (HEAD + "4 -2 1\n6\n", 2, "has a size"),
        (HEAD + "13 0 0\n6\n", 2, "exceeds"),
        (HEAD + "4 2 1\n5\n", 3, "doesn't reach"),
        (HEAD + "4 2 0\n6\n", 3, "doesn't reach"),
    ],
)
def test_broken_lines_are_named(spark, tmp_path, contigs, text, line, reason):
    with pytest.raises(RowError, match=f"line {line}: .*{reason}" if line else reason):
        read(spark, tmp_path, contigs, text)


def test_limit_of_blocks(spark, tmp_path, contigs):
    with pytest.raises(ContractError, match="more than 5 blocks"):
        read(spark, tmp_path, contigs, GOOD, most_blocks=5)
    assert read(spark, tmp_path, contigs, GOOD, most_blocks=6).count() == 6


def test_sums_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(readers, "RANGE", 7)
    rows = spark.range(100).selectExpr("id * 3 as at", "id % 4 as g", "id as x")
    got = {r.at: (r.a, r.b) for r in readers.sums_before(rows, ["g"], "at", a=rows.x, b=rows.x * 0 + 1).collect()}
    assert got == {3 * i: (sum(range(i % 4, i, 4)), i // 4) for i in range(100)}


def _walked(lines):
    """What a sequential reader says of the places of lines; other rules are left to the cases above."""
    bad, head, t, q, ended, has = {}, None, 0, 0, False, {}
    for row, value in lines:
        f = value.split()
        if f[0] == "chain":
            head, t, q, ended, has[row] = row, int(f[5]), int(f[10]), False, False
            t1, q1 = int(f[6]), int(f[11])
            continue
        size, dt, dq = (int(f[i]) if i < len(f) else 0 for i in range(3))
        if head is None:
            bad[row] = "a block outside a chain"
        elif ended:
            bad[row] = "a block after the last one of its chain"
        elif t + size > t1 or q + size > q1:
            bad[row] = "a block exceeds the declared ends"
        elif len(f) == 1 and (t + size, q + size) != (t1, q1):
            bad[row] = "the last block doesn't reach the declared ends"
        if head is not None:
            t, q, ended = t + size + dt, q + size + dq, ended or len(f) == 1
            has[head] |= len(f) == 1
    return bad | {r: "the chain has no last block" for r, ok in has.items() if not ok}


@pytest.mark.parametrize("wide", [1, 3, 16, 65536])
def test_chains_over_ranges(spark, monkeypatch, wide):
    """Chains shorter and longer than a range, some of whose lines are lost or misplaced; lines are shuffled once and no join sorts them."""
    import random

    monkeypatch.setattr(chains, "RANGE", wide)
    rnd, lines, at = random.Random(wide), [(2, "5 1 1")], 3
    for c in range(40):
        blocks = [(rnd.randrange(1, 9), rnd.randrange(3), rnd.randrange(3)) for _ in range(rnd.choice([1, 2, 3, 5, 40]))]
        size, dt, dq = sum(b[0] for b in blocks), sum(b[1] for b in blocks[:-1]), sum(b[2] for b in blocks[:-1])
        own = [f"chain 1 chrA 9000 + {c} {c + size + dt + (c % 7 == 3) - (c % 7 == 5)} chrA 9000 + 3 {3 + size + dq} c{c}", *[" ".join(map(str, b)) for b in blocks[:-1]], str(blocks[-1][0])]
        own = own[:-1] if c % 5 == 4 else own[:1] + own[2:] if c % 11 == 6 else [*own, "3 0 0", "4"] if c % 9 == 5 else own
        for value in own:
            at += rnd.choice([1, 1, 1, 2, 9])
            lines.append((at, value))
    contigs = spark.createDataFrame([("chrA", 9000)], "chr string, length long")
    found = chains.chain_lines(spark.createDataFrame(lines, "src_row long, value string").repartition(3), contigs, contigs)[0]
    want = _walked(lines)
    assert {r.src_row: r.reason for r in found.collect()} == want and len(set(want.values())) == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
