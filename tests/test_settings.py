"""The settings queries run under."""

import __spark_entry__ as entry
import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["hash_large_integers", "record_messages", "bookmark_lookup", "changed_only"])
def test_no_table_is_broadcast_by_the_size_of_its_files(spark, name, capsys):
    """Texts and hashes made of a small file's columns are large, so that only measured sizes may decide."""
    entry.queries()[name](spark, SF).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_operators_keep_the_default(spark):
    entry.queries()["op2_sharding"](spark, SF)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10MB"
    entry.queries()["get_path"](spark, SF)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
