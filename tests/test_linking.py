from tickerlens.operators import linking
from tickerlens.operators.linking import carry_forward


def test_link_last_master_row_wins_and_no_trim(spark):
    master = spark.createDataFrame([("Acme", "000001", 1), ("Acme", "000002", 2), ("Beta", "000003", 3)],
                                   "name string, code string, row_no long")
    h = spark.createDataFrame([(1, "Acme, up"), (2, " Acme, x"), (3, "Be-ta"), (4, "Beta-1")],
                              "seq long, title string")
    got = {r.seq: (r.code, r.content) for r in linking.link_headlines(h, master).collect()}
    # "Be-ta" cleans to "Beta" (the clean set includes "-"), so it links too
    assert got == {1: ("000002", "Acme, up"), 3: ("000003", "Beta")}


def test_candidate_counts_literal_and_empty_key(spark):
    master = spark.createDataFrame([("Acme Corp", "1", 1), ("Acme", "2", 2), ("Zeta", "3", 3)],
                                   "name string, code string, row_no long")
    keys = spark.createDataFrame([("Acme",), ("",), ("me C",), ("x.y",), ("Acme Corp Plus",)], "key string")
    got = {r.key: r.n_candidates for r in linking.candidate_counts(keys, master).collect()}
    assert got == {"Acme": 2, "": 3, "me C": 1, "x.y": 0, "Acme Corp Plus": 0}


def test_carry_forward_across_chunks(spark):
    rows = [("d1", 1, "A"), ("d1", 2, None), ("d1", 3, None), ("d1", 7, "B"), ("d1", 9, None),
            ("d2", 1, None), ("d2", 5, "C"), ("d2", 6, None)]
    df = spark.createDataFrame(rows, "run string, seq long, code string")
    out = carry_forward(df, ["code"], "run", "seq", chunk_rows=2)
    got = {(r.run, r.seq): r.code_carried for r in out.collect()}
    assert got == {("d1", 1): "A", ("d1", 2): "A", ("d1", 3): "A", ("d1", 7): "B", ("d1", 9): "B",
                   ("d2", 1): None, ("d2", 5): "C", ("d2", 6): "C"}


def test_legacy_carry_link(spark):
    master = spark.createDataFrame([("Acme", "000001", 1), ("Acme Two", "000002", 2)],
                                   "name string, code string, row_no long")
    h = spark.createDataFrame([("d", 1, "Ac, x"), ("d", 2, "Acme, y"), ("d", 3, "Ac, z"), ("d", 4, "Q, n")],
                              "run_date string, seq long, title string")
    got = {r.seq: (r.code, r.exact) for r in linking.link_with_legacy_carry(h, master).collect()}
    assert got == {1: ("", False), 2: ("000001", True), 3: ("000001", False)}


def test_new_only_anti_join(spark):
    df = spark.createDataFrame([(1, "A", "d1"), (2, "A", "d2"), (3, "B", "d1"), (4, "A", "d1")],
                               "seq long, code string, d string")
    store = spark.createDataFrame([("A", "d1")], "code_ string, date_ string")
    got = sorted(r.seq for r in linking.new_only(df, store, [("code", "code_"), ("d", "date_")]).collect())
    assert got == [2, 3]


def test_names_are_dealt_out_before_their_substrings_are_made(spark):
    from tickerlens.session import ROWS_A_TASK
    master = spark.createDataFrame([("aaba",), ("aaba",), ("ba",), ("",), (None,)], "name string")
    idx = linking.name_substring_index(master, [1, 2, 9])
    assert {tuple(r) for r in idx.collect()} == {("a", 2), ("b", 2), ("aa", 1), ("ab", 1), ("ba", 2)}
    assert {tuple(r) for r in linking.name_substring_index(master).where("length(sub) < 3").collect()} == {tuple(r) for r in idx.collect()}
    more = linking.name_substring_index(master, [1], 20 * ROWS_A_TASK)
    assert "Repartition 20," in more._jdf.queryExecution().optimizedPlan().toString()
