"""Scratch tables: who deletes what, and when."""

import threading

import pytest

from broadsheet import session as S


def test_other_threads_keep_their_tables(spark):
    made = {}

    def other():
        made["table"] = S.settle(spark.range(3), "theirs")

    with S.passing_scratch(spark) as keep:
        mine = keep(S.settle(spark.range(5), "mine"))
        gone = S.settle(spark.range(7), "gone")
        thread = threading.Thread(target=other)
        thread.start()
        thread.join()
    assert mine.count() == 5 and made["table"].count() == 3
    with pytest.raises(Exception, match="(?i)exist|not found"):
        gone.count()


def test_an_error_deletes_too(spark):
    with pytest.raises(ValueError):
        with S.passing_scratch(spark) as keep:
            left = keep(S.settle(spark.range(2), "kept"))
            with S.passing_scratch(spark):
                gone = S.settle(spark.range(2), "inner")
                raise ValueError("stop")
    assert left.count() == 2
    with pytest.raises(Exception, match="(?i)exist|not found"):
        gone.count()


def test_root_without_a_configured_folder(spark):
    assert S.scratch_root(spark) == S.scratch_root(spark)
