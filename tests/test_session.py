"""Work tables: written once, released as soon as nothing reads them."""

import os

from rsvpark import session as S


def _there(df):
    return os.path.isdir(df._rsvpark_work.removeprefix("file:"))


def test_release_removes_tables_and_folders(spark):
    a = S.materialize(spark.range(10), "t")
    b = S.bucketed(spark.range(10), ["id"], "t")
    name = b._rsvpark_table
    assert _there(a) and _there(b) and a.count() == b.count() == 10
    S.release(a, b, None, spark.range(3))
    assert not _there(a) and not _there(b) and not spark.catalog.tableExists(name)
    S.release(a, b)         # again does nothing


def test_what_is_left_goes_when_the_driver_ends(spark):
    a = S.materialize(spark.range(10), "t")
    assert a._rsvpark_work in S._KEPT
    kept = dict(S._KEPT)
    try:
        for path in list(S._KEPT):
            if path != a._rsvpark_work:
                S._KEPT.pop(path)
        S._drop_kept()
    finally:
        S._KEPT.update({p: s for p, s in kept.items() if p != a._rsvpark_work})
    assert not _there(a)


def test_a_scope_removes_what_was_written_in_it(spark):
    with S.work_scope(spark):
        a, b = S.materialize(spark.range(4), "t"), S.bucketed(spark.range(4), ["id"], "t")
        assert _there(a) and _there(b)
    assert not _there(a) and not _there(b)
