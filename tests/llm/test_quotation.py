from sondar.llm import quotation


def rows_of(spark, rows, **names):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, text string, body string")
    return {(r.conv_id, r.turn): r for r in quotation.threads(frame).collect()}


def test_replies_are_found_through_quotes(spark):
    first = "Shall we meet on Tuesday?\nOr rather later."
    got = rows_of(spark, [
        (1, 0, first, "x"),
        (1, 1, "> Shall we  meet on TUESDAY\n\nYes.", None),
        (1, 2, "> Or rather later.\nNo, later.", None),
        (1, 3, ">> Shall we meet on Tuesday? Or rather\n>> later.\n> Yes.\n \nFine then.\n> \n", None),
        (1, 4, "> nobody said this\nWho did?", None),
        (2, 0, "> Shall we meet on Tuesday?\nAnother conversation.", None),
        (3, 0, None, None),
        (None, 1, "> x\nalone", None),
    ])
    assert [got[1, t].parent_turn for t in range(5)] == [None, 0, 0, 1, None]
    assert [got[1, t].depth for t in range(5)] == [0, 1, 1, 2, 0]
    assert got[1, 3].root_turn == 0 and got[1, 3].n_quoted == 2 and got[1, 3].n_linked == 2
    assert got[1, 1].body == "Yes." and got[1, 2].body == "No, later." and got[1, 3].body == "Fine then."
    assert got[1, 4].n_quoted == 1 and got[1, 4].n_linked == 0 and got[1, 4].root_turn == 4
    assert got[2, 0].parent_turn is None and got[3, 0].body == "" and got[None, 1].body == "alone"


def test_the_latest_source_counts_and_rows_stay(spark):
    same = "The same words again."
    got = spark.createDataFrame(
        [(1, 0, same), (1, 1, "other"), (1, 2, same), (1, 3, f"> {same}\nWhich one?"), (1, 3, f"> {same}\nWhich one?"), (1, 5, f">{same}\n" * 3)],
        "conv_id long, turn long, text string")
    rows = quotation.threads(got).collect()
    assert len(rows) == 6
    assert {r.parent_turn for r in rows if r.turn in (3, 5)} == {2}
    assert quotation.threads(got.limit(0)).count() == 0


def test_long_chains(spark):
    rows = [(7, 0, "start here")] + [(7, n, f"> message number {n - 1}\nmessage number {n}" if n > 1 else "> start here\nmessage number 1") for n in range(1, 60)]
    got = quotation.threads(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()
    assert sorted((r.turn, r.depth, r.root_turn) for r in got) == [(n, n, 0) for n in range(60)]


def test_given_conversations_come_back(spark, sf):
    given = spark.read.parquet(f"{sf}/conversations.parquet")
    got = {(r.conv_id, r.turn): r for r in quotation.threads(quotation.quoting(given)).collect()}
    for r in given.collect():
        found = got[r.conv_id, r.turn]
        assert found.body == r.text and found.depth == r.turn and (found.parent_turn is None) == (r.turn == 0)


def test_no_python_in_the_plan(spark, sf, capsys):
    quotation.threads(quotation.quoting(spark.read.parquet(f"{sf}/conversations.parquet"))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
