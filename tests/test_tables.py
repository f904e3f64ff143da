from pyspark.sql import functions as F

from skein.operators import tables


def _rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_upsert_coalesce_semantics_and_idempotence(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k long, v string, w string")
    upd = spark.createDataFrame([(1, None, "y", 2), (1, "first", None, 1), (3, "c", None, 1)],
                                "k long, v string, w string, seq long")
    once = tables.upsert_coalesce(base, upd, ["k"], order=["seq"])
    got = _rows(once, "k")
    assert got[1] == {"k": 1, "v": "first", "w": "x"}     # first row of the batch; null keeps old
    assert got[2] == {"k": 2, "v": "b", "w": None}
    assert got[3] == {"k": 3, "v": "c", "w": None}
    twice = tables.upsert_coalesce(once, upd, ["k"], order=["seq"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_upsert_overwrite_sets_nulls(spark):
    base = spark.createDataFrame([(1, "a", "x")], "k long, v string, w string")
    upd = spark.createDataFrame([(1, None, "z"), (2, "n", "m")], "k long, v string, w string")
    got = _rows(tables.upsert_overwrite(base, upd, ["k"], ["v"]), "k")
    assert got[1] == {"k": 1, "v": None, "w": "x"}
    assert got[2] == {"k": 2, "v": "n", "w": "m"}


def test_combine_first_old_wins(spark):
    old = spark.createDataFrame([(1, 1.0, None)], "k long, o double, c double")
    new = spark.createDataFrame([(1, 9.0, 2.0), (2, 3.0, 4.0)], "k long, o double, c double")
    got = _rows(tables.combine_first(old, new, ["k"]), "k")
    assert got[1] == {"k": 1, "o": 1.0, "c": 2.0}
    assert got[2] == {"k": 2, "o": 3.0, "c": 4.0}


def test_delete_range_and_channel(spark):
    df = spark.createDataFrame([(1, i) for i in range(10)] + [(2, 5), (None, 5)], "chat_id long, message_id long")
    assert tables.delete_range(df, 1, 3, 5).count() == 9
    assert tables.delete_range(df, 1, 3, 5, inclusive_low=False).count() == 10
    assert tables.delete_channel(df, 1).count() == 2


def test_dense_index_consecutive(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(7)
    idx = tables.dense_index(df, ["v"], start=10)
    vals = sorted((r.idx, r.v) for r in idx.collect())
    assert [i for i, _ in vals] == list(range(10, 5010))
    assert [v for _, v in vals] == sorted(v for _, v in vals)


def test_dictionary_encode_keeps_ids_and_marks_custom(spark):
    m0 = spark.createDataFrame([(1, "a", False)], "reaction_id int, reaction string, is_custom boolean")
    vals = spark.createDataFrame([("a",), ("c",), ("b",), ("123",), ("b",)], "r string")
    got = {r.reaction: (r.reaction_id, r.is_custom) for r in tables.dictionary_encode(vals, "r", m0).collect()}
    assert got == {"a": (1, False), "123": (2, True), "b": (3, False), "c": (4, False)}


def test_latest_setting_tombstones(spark):
    log = spark.createDataFrame([("p", "k", "1", 1, "set"), ("p", "k", "2", 2, "set"), ("p", "j", "x", 3, "set"),
                                 ("p", "j", None, 4, "unset")], "project string, key string, value string, "
                                                                 "seq long, op string")
    got = {(r.project, r.key): r.value for r in tables.latest_setting(log).collect()}
    assert got == {("p", "k"): "2"}
    req = spark.createDataFrame([("p", "k"), ("p", "j")], "project string, key string")
    vals = {r.key: r.value for r in tables.get_setting(tables.latest_setting(log), req, "dflt").collect()}
    assert vals == {"k": "2", "j": "dflt"}


def test_dedupe_first_by_key_sort_specs(spark):
    df = spark.createDataFrame([(1, None, 5.0), (1, 2.0, 1.0), (1, 3.0, 9.0), (2, None, 1.0)],
                               "k long, a double, b double")
    nulls_last = {r.k: (r.a, r.b) for r in tables.dedupe_first_by_key(df, ["k"], [("a", False, True)]).collect()}
    assert nulls_last == {1: (2.0, 1.0), 2: (None, 1.0)}
    nulls_first = {r.k: (r.a, r.b) for r in tables.dedupe_first_by_key(df, ["k"], ["a"]).collect()}
    assert nulls_first[1] == (None, 5.0)
    desc_b = {r.k: (r.a, r.b) for r in tables.dedupe_first_by_key(df, ["k"], [("b", True, False)]).collect()}
    assert desc_b[1] == (3.0, 9.0)


def test_counts_kept_by_signed_changes_equal_the_full_count(spark, tmp_path):
    import random
    from skein.operators import language
    from skein.sources import buckets
    r = random.Random(3)
    text = lambda: r.choice([None, "", "abc", "שלום", "سلام", "שלום abc سلام", "12"])
    table = {i: (r.randrange(6), text()) for i in range(200)}
    cols, schema = "chat_id long, text string", "chat_id long, messages long, " + ", ".join(f"{c} long" for c in language.STAT_COLS)
    frame = lambda rows: spark.createDataFrame(list(rows), cols)
    root = str(tmp_path)
    buckets.create_store(language.signed_counts(frame(table.values()).withColumn("sign", F.lit(1))), root, ["chat_id"], 4)
    for step in range(2):
        old, new = [], []
        for i in r.sample(sorted(table), 60) + [k for k, v in table.items() if step and v[0] == 2]:
            if i in table:
                old.append(table.pop(i))
                if r.random() < 0.5 and not (step and old[-1][0] == 2):
                    table[i] = (old[-1][0], text())
                    new.append(table[i])
        for i in range(1000 * (step + 1), 1000 * (step + 1) + 20):
            table[i] = (r.choice([0, 7, 8]), text())
            new.append(table[i])
        changes = language.signed_counts(language.signed_changes(frame(old), frame(new)))
        buckets.merge_store(changes, root, schema, ["chat_id"], 4, language.add_counts)
        want = sorted(map(tuple, language.chat_counts(frame(table.values())).collect()))
        assert sorted(map(tuple, buckets.read_store(spark, root, schema).drop("messages").collect())) == want
    assert 2 not in [w[0] for w in want]  # a chat whose messages are all gone
