import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from skein import schemas
from skein.operators import normalize, tables
from skein.sources import readers


def _doc(**kw):
    base = {f.name: None for f in schemas.RAW_MESSAGE.fields}
    base.update(kw)
    return base


def _raw(spark, docs):
    return spark.createDataFrame([Row(**d) for d in docs], schemas.RAW_MESSAGE)


def test_text_media_sender_and_vote_totals(spark):
    R = lambda e, c, n: {"emoji": e, "custom_emoji_id": c, "count": n}
    docs = [
        _doc(id=1, chat={"id": 5}, text="", caption="cap", from_user={"id": 7},
             reactions={"reactions": [R("👍", None, 3), R(None, 99, 2), R("👍", None, 1)]},
             photo={"file_id": "p", "file_unique_id": "pu"}, document={"file_id": "d", "file_unique_id": "du"}),
        _doc(id=2, chat={"id": 5}, poll={"question": "q?", "options": [{"text": "a", "voter_count": 1},
                                                                        {"text": "b", "voter_count": 0},
                                                                        {"text": "a", "voter_count": 4}]},
             sender_chat={"id": -100}, reactions={"reactions": []}),
        _doc(id=3, chat={"id": 5}, outgoing=True, text="mine"),
        _doc(id=None, chat={"id": 5}, text="no id"),
    ]
    raw = _raw(spark, docs)
    m = {r.message_id: r for r in normalize.flatten_messages(raw).collect()}
    assert set(m) == {1, 2}
    assert m[1].text == "cap" and m[1].sender_id == 7 and m[1].media_type == "document"
    assert m[1].reactions_vote_count == 3 and m[1].poll_vote_count is None
    assert m[2].text == "q?" and m[2].sender_id == -100 and m[2].poll_vote_count == 4
    assert m[2].reactions_vote_count is None          # empty nested list -> null total
    emap = tables.dictionary_encode(normalize._reaction_items(raw), "reaction",
                                    spark.createDataFrame([], "reaction_id int, reaction string, is_custom boolean"))
    reac = {r.reaction_id: r for r in normalize.explode_reactions(raw, emap).collect()}
    by_abs = sorted((r.reaction_votes_abs, round(r.reaction_votes_norm, 4)) for r in reac.values())
    assert by_abs == [(1, 0.3333), (2, 0.6667)]        # equal keys: last count wins
    polls = sorted((r.poll_option_id, r.poll_option_text, r.votes_abs) for r in normalize.explode_poll(raw).collect())
    assert polls == [(0, "a", 4), (1, "b", 0)]


def test_merge_non_null_last_value(spark):
    rows = spark.createDataFrame([(1, "t1", None, 1), (1, None, "u", 2), (1, "t3", None, 3), (2, None, None, 1)],
                                 "chat_id long, title string, username string, seq long")
    got = {r.chat_id: r for r in normalize.merge_non_null(rows, "chat_id", "seq").collect()}
    assert got[1].title == "t3" and got[1].username == "u"
    assert got[2].title is None
    known = spark.createDataFrame([(2,)], "chat_id long")
    assert normalize.merge_non_null(rows, "chat_id", "seq", known).count() == 1


def test_nest_unnest_roundtrip(spark):
    msgs = spark.createDataFrame([(1, 1), (1, 2)], "chat_id long, message_id long")
    reac = spark.createDataFrame([(1, 1, 3, 0.25, 1), (1, 1, 1, 0.75, 3)],
                                 "chat_id long, message_id long, reaction_id int, reaction_votes_norm double, "
                                 "reaction_votes_abs int")
    polls = spark.createDataFrame([], "chat_id long, message_id long, poll_option_id int, poll_option_text string, "
                                      "votes_norm double, votes_abs int")
    nested = normalize.nest(msgs, reac, polls)
    back = normalize.unnest_reactions(nested)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, reac.collect()))


def test_split_valid(spark):
    df = spark.createDataFrame([(1, 5, "photo"), (2, -1, "photo"), (3, None, "hologram"), (4, None, None)],
                               "message_id long, views int, media_type string")
    ok, bad = normalize.split_valid(df, "messages")
    assert sorted(r.message_id for r in ok.collect()) == [1, 4]
    assert sorted(r.message_id for r in bad.collect()) == [2, 3]


def test_doc_any_text_first(spark):
    docs = [_doc(id=5, chat={"id": 1}, caption="c5"), _doc(id=3, chat={"id": 1}, text="t3"),
            _doc(id=4, chat={"id": 1}), _doc(id=2, chat={"id": 2}, poll={"question": "q", "options": []})]
    raw = _raw(spark, docs)
    all_rows = normalize.doc_any_text(raw, chat_id=1).collect()
    assert sorted((r.message_id, r.text) for r in all_rows) == [(3, "t3"), (5, "c5")]
    one = normalize.doc_any_text(raw, chat_id=1, first=True).collect()
    assert [(r.message_id, r.text) for r in one] == [(3, "t3")]


def test_free_documents_keep_unknown_fields_and_reject_deep_ones(spark, tmp_path):
    import json

    def clean(d, level=1):
        """The plain rule: null fields go at every level, a value below level 25 is an error."""
        if level > 25:
            raise ValueError
        if isinstance(d, list):
            return [clean(x, level + 1) for x in d]
        if isinstance(d, dict):
            return {k: v for k, v in ((k, clean(v, level + 1)) for k, v in d.items()) if v is not None}
        return d

    def nested(n, inner, kind=list):
        for _ in range(n):
            inner = [inner] if kind is list else {"a": inner}
        return inner

    odd = 'a "b":null, \\ {[ é 🙂 ]} \n'
    docs = [{"a": 1, "b": None, "c": {"d": None}, "e": {"f": {"g": None, "h": [None, {"i": None, "j": 2}]}}}, {}, {"a": None},
            {odd: None, "k" + odd: odd, "z": {odd: None}}, {"x": odd, "y": None}, {"null": "null", "n": "x:null"},
            *({"v": nested(n, inner, kind)} for n in (22, 23, 24, 25) for inner in (1, None, [], {}, {"q": None}) for kind in (list, dict)),
            {"id": 10**15, "f": 1.5, "t": True, "u": "\u0000"}]
    good, bad = [], []
    for d in docs:
        try:
            good.append(json.dumps(clean(d), sort_keys=True))
        except ValueError:
            bad.append(json.dumps(d))
    other = ["", "[1]", "3", "null", '{"a":1', '{"a":1}}', '{"a":1} {"b":2}', '{"a":1}x']
    (tmp_path / "d.json").write_text("\n".join([*map(json.dumps, docs), *other]))
    found, rejects = readers.read_free_documents(spark, str(tmp_path / "d.json"))
    found.write.parquet(str(tmp_path / "store"))
    back = spark.read.parquet(str(tmp_path / "store")).select(F.to_json("doc").alias("j")).collect()
    assert sorted(json.dumps(json.loads(r.j), sort_keys=True) for r in back) == sorted(good)
    assert sorted(r.line for r in rejects.collect()) == sorted(bad + other)
    assert len(bad) >= 10
