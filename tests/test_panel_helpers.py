"""List-order predicates (cursor, watch list) and the shared folder."""

from tidemark.operators import panel as P


def _symbols(spark):
    return spark.createDataFrame([("MSFT", "M", 0), ("GOOG", "G", 1), ("TSLA", "T", 2)],
                                 "id string, sector string, pos int")


def test_symbols_after_cursor(spark):
    s = _symbols(spark)
    ids = lambda df: [r.id for r in df.orderBy("pos").collect()]
    assert ids(P.symbols_after(s, "GOOG")) == ["TSLA"]
    assert ids(P.symbols_after(s, "TSLA")) == []
    assert ids(P.symbols_after(s, "")) == ["MSFT", "GOOG", "TSLA"]          # blank cursor
    assert ids(P.symbols_after(s, "NOPE")) == ["MSFT", "GOOG", "TSLA"]      # unknown cursor
    assert P.last_symbol(s).first().id == "TSLA"
    assert P.first_symbol(s).first().id == "MSFT"


def test_watched_symbols_keep_list_order(spark):
    w = P.watched_symbols(_symbols(spark), " tsla, TSLA ,,MSFT, GOOG ,MSFT")
    assert [(r.id, r.wpos) for r in w.orderBy("wpos").collect()] == \
        [("TSLA", 1), ("MSFT", 3), ("GOOG", 4)]


def test_shared_dir_comes_from_the_session(spark):
    from tidemark.session import scratch_path, shared_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    d = shared_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir()
    if configured:
        assert configured.rstrip("/") in d
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d.rstrip("/"))
