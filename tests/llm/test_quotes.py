from tests.llm.helpers import read, sql_rows
from wayfare.llm.oracles import quotes_sql
from wayfare.llm.quotes import chat_query, link_quotations, quotation_links

MESSAGES = "conv_id long, turn long, role string, text string"


def linked(spark, rows):
    out = {}
    for r in link_quotations(spark.createDataFrame(rows, MESSAGES)).collect():
        out.setdefault((r["conv_id"], r["turn"]), []).append(r)
    return out


def test_nested_quotes_threads_and_clean_texts(spark):
    rows = [(1, 0, "user", "Where is  the station?\nI am lost."), (1, 1, "assistant", "Which town?"),
            (1, 2, "user", "> Which town?\nThe old one."),
            (1, 3, "assistant", "> > Which town?\n> The old one.\nThen go left."),
            (1, 4, "user", ">where is the   STATION?\n\nStill no answer"),
            (1, 5, "user", "> never said by anyone\nhm"), (1, 6, "user", "> Then go left.\n> The old one."),
            (2, 1, "user", "> Which town?\nother conversation")]
    got = {k: v[0] for k, v in linked(spark, rows).items()}
    view = {k: (r["reply_to"], r["thread_turn"], r["depth"], r["quote_level"], r["n_quotes"], r["text"])
            for k, r in got.items()}
    assert view == {
        (1, 0): (None, 0, 0, 0, 0, "Where is  the station?\nI am lost."), (1, 1): (None, 1, 0, 0, 0, "Which town?"),
        (1, 2): (1, 1, 1, 1, 1, "The old one."), (1, 3): (2, 1, 2, 2, 2, "Then go left."),
        (1, 4): (0, 0, 1, 1, 1, "\nStill no answer"), (1, 5): (None, 5, 0, 1, 1, "hm"),
        (1, 6): (3, 1, 3, 1, 1, ""), (2, 1): (None, 1, 0, 1, 1, "other conversation")}
    assert got[1, 2]["formatted"] == "<|user|>\nThe old one.\n"


def test_message_that_quotes_only_nested_lines_is_linked(spark):
    rows = [(1, 0, "user", "Where is the station?"), (1, 1, "assistant", "> Where is the station?\nIn the north."),
            (1, 2, "user", ">> Where is the station?\nThanks."), (1, 3, "user", "> > > In the north.\nReally?"),
            (1, 4, "user", ">> Where is the station?\n> Thanks.\nFine."),
            (1, 5, "user", ">> Where is the station?\n> unknown\nOh.")]
    got = {k: v[0] for k, v in linked(spark, rows).items()}
    assert {k[1]: (r["reply_to"], r["thread_turn"], r["depth"]) for k, r in got.items()} == {
        0: (None, 0, 0), 1: (0, 0, 1), 2: (0, 0, 1), 3: (1, 0, 2), 4: (2, 0, 2), 5: (0, 0, 1)}
    links = quotation_links(spark.createDataFrame(rows, MESSAGES)).collect()
    assert sorted((r["turn"], r["level"], r["parent"]) for r in links) == [
        (1, 1, 0), (2, 2, 0), (3, 3, 1), (4, 1, 2), (4, 2, 0), (5, 2, 0)]


def test_long_chain(spark):
    rows = [(1, 0, "user", "line 0")] + [(1, k, "user", f"> line {k - 1}\nline {k}") for k in range(1, 40)]
    got = {k: v[0] for k, v in linked(spark, rows).items()}
    assert all(got[1, k]["depth"] == k and got[1, k]["thread_turn"] == 0 for k in range(40))


def test_odd_rows(spark):
    rows = [(None, 1, "user", "> a\nb"), (1, None, "user", "a"), (1, 1, None, None), (1, 1, None, None),
            (1, 2, "user", "> \n>\n"), (1, 3, "user", ">" * 50 + " deep"), (1, 4, "u", "x" * 50_000),
            (1, 5, "u", "> " + "x" * 50_000), (1, 5, "u", "> " + "x" * 50_000)]
    got = linked(spark, rows)
    assert sum(map(len, got.values())) == len(rows)
    assert [r["reply_to"] for r in got[1, 5]] == [4, 4] and [r["text"] for r in got[1, 5]] == ["", ""]
    assert [r["text"] for r in got[1, 1]] == ["", ""] and got[1, 3][0]["quote_level"] == 50
    assert got[None, 1][0]["text"] == "b" and got[None, 1][0]["reply_to"] is None
    assert chat_query(spark.createDataFrame([], MESSAGES)).collect() == []


def test_table_without_quotes_is_unchanged(spark):
    table = read(spark, "conversations")
    got = chat_query(table.withColumnRenamed("text", "body").selectExpr("*", "body as text", "1 as parent", "2 as depth"))
    key = lambda r: (r["conv_id"], r["turn"], r["text"])
    assert sorted(map(key, got.collect())) == sorted(map(key, table.collect()))


def same_as_sql(spark, rows):
    columns, want = sql_rows(quotes_sql(), rows)
    got = [tuple(r[c] for c in columns) for r in chat_query(spark.createDataFrame(rows, MESSAGES)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_equals_sql_on_nested_quotes(spark):
    rows = [(1, 0, "user", "Where is  the station?\nI am lost."), (1, 1, "assistant", "Which town?"),
            (1, 2, "user", "> Which town?\nThe old one."), (1, 3, "assistant", "> > Which town?\n> The old one.\nThen go left."),
            (1, 4, "user", ">where is the   STATION?\n\nStill no answer"), (1, 5, "user", "> never said\nhm"),
            (1, 6, "user", "> Then go left.\n> The old one."), (2, 1, "user", "> Which town?\nother"),
            (3, 0, "user", "In the north."), (3, 1, "user", ">> In the north.\nSo?"), (3, 2, "user", "> > > In the north.\n> So?\nYes."),
            (3, 3, None, ">> So?\n> unknown\nOh."), (3, 4, "user", ">\n>\n> "), (None, 1, "user", "> a\nb"), (4, None, "user", "> a"),
            (5, 0, "u", "twice"), (5, 1, "u", "> twice\n>> twice"), (5, 1, "u", "> twice\n>> twice"), (5, 2, "u", "\t> twice\n x"),
            (6, 0, "u", "line 0")] + [(6, k, "user", f"> line {k - 1}\n{'>' * k} line 0\nline {k}") for k in range(1, 12)]
    same_as_sql(spark, rows)


def test_long_runs_of_marks(spark):
    rows = [(1, 0, "u", "deep"), (1, 1, "u", ">" * 100_000 + " deep\nover"), (1, 2, "u", "> " * 50_000 + "over"),
            (1, 3, "u", " " * 100_000 + "x"), (1, 4, "u", ">\n" * 20_000)]
    got = {k[1]: v[0] for k, v in linked(spark, rows).items()}
    assert got[1]["quote_level"] == 100_000 and got[1]["reply_to"] == 0 and got[1]["text"] == "over"
    assert got[2]["quote_level"] == 50_000 and got[2]["reply_to"] == 1
    assert got[3]["quote_level"] == 0 and got[4]["text"] == ""
