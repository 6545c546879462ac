import random

from dosewise.llm import lines


def brute(texts, min_chars):
    """All runs that occur at an earlier place and are long enough, by trying every one."""
    split = {i: t.split("\n") for i, t in texts.items() if t is not None}
    seen, gone = {}, set()
    for i in sorted(split):
        for a in range(len(split[i])):
            for b in range(a + 1, len(split[i]) + 1):
                run = tuple(split[i][a:b])
                if sum(map(len, run)) + len(run) < min_chars:
                    continue
                if run in seen and seen[run] < (i, a):
                    gone |= {(i, line) for line in range(a, b)}
                seen.setdefault(run, (i, a))
    return gone


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")


def check(spark, texts, min_chars):
    gone = brute(texts, min_chars)
    found = {(r.doc_id, r.line) for r in lines.copied_lines(frame(spark, texts), min_chars).collect()}
    assert found == gone
    kept = {r.doc_id: r.text for r in lines.dedup(frame(spark, texts), min_chars).collect()}
    expected = {}
    for i, text in texts.items():
        if text is None:
            expected[i] = None
            continue
        parts = text.split("\n")
        left = [p for n, p in enumerate(parts) if (i, n) not in gone]
        if left:
            expected[i] = "\n".join(left)
    assert kept == expected


def test_against_brute_force(spark):
    rng = random.Random(3)
    pool = ["a", "bb", "", "four", "a longer line here", "the longest of all the lines, by far"]
    texts = {i: "\n".join(rng.choices(pool, k=rng.randint(1, 9))) for i in range(25)}
    texts |= {30: None, 31: "", 32: "\n\n\n\n\n\n\n\n", 33: "x\n" * 40, 34: texts[3], 35: texts[3] + "\nown"}
    check(spark, texts, 12)


def test_long_runs_of_short_lines(spark):
    rng = random.Random(4)
    block = [rng.choice("ab") for _ in range(12)]
    texts = {i: "\n".join([*(rng.choices("abc", k=4)), *block, f"end {i}"]) for i in range(6)}
    check(spark, texts, 18)
    check(spark, texts, 1)


def test_empty_nulls_repeats_and_extra_columns(spark):
    schema = "doc_id bigint, text string, line string, `all.lines` int"
    assert lines.dedup(spark.createDataFrame([], schema)).collect() == []
    long = "this line is long enough to count as a run"
    rows = [(None, long, "a", 1), (1, long, "b", 2), (2, f"own\n{long}", "c", 3), (2, f"own\n{long}", "d", 3),
            (3, None, None, None), (4, f"tail\n{'word ' * 30000}", "e", 5)]
    got = lines.dedup(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "text", "line", "all.lines"]
    texts = sorted((r[0] or -1, r[1] or "", r[2] or "") for r in got.collect())
    # The null id is first; rows that are equal in id and text fare alike.
    assert texts == [(-1, long, "a"), (2, "own", "c"), (2, "own", "d"), (3, "", ""), (4, rows[-1][1], "e")]


def test_no_python_in_the_plan(spark):
    plan = lines.dedup(frame(spark, {1: "a"}))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
