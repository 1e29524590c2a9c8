"""The command line, job after job, as a user runs it."""

import pytest

from harness.fixtures import Given
from souklake.__main__ import main
from souklake.plans.validate import ValidationError

SF_DIR = "/root/testdata/sf0.001"


def test_jobs_in_order(spark, tmp_path):
    bronze, snapshot, lake = (f"{tmp_path}/{name}" for name in ("bronze", "snapshot", "lake"))
    assert main(["seed", "--snapshot", snapshot])["products"] == 4_000
    assert main(["seed", "--snapshot", snapshot]) == {}
    assert main(["check", "--phase", "setup", "--snapshot", snapshot])["rules"] > 30
    manifest = main(["history", "--bronze", bronze, "--budget", "3000000"])
    assert manifest["rows"]["transaction_products"] == 2 * manifest["rows"]["transactions"]
    audit = main(["batch", "--bronze", bronze, "--snapshot", snapshot, "--lake", lake])
    assert audit["gold_rows"]["buyer_360"] == 10_000
    checked = main(["check", "--phase", "batch", "--bronze", bronze, "--snapshot", snapshot, "--lake", lake])
    assert checked["rules"] > 30
    # So small a history does not cover the reference domain, and the check says so.
    with pytest.raises(ValidationError, match="transaction domain"):
        main(["check", "--phase", "history", "--bronze", bronze])


def test_landing(spark, tmp_path):
    source, landing = f"{tmp_path}/changes", f"{tmp_path}/landing"
    feed = Given(spark, SF_DIR).changes().where("raw like '%table%'").select("lsn", "xid", "raw")
    feed.write.parquet(source)
    arguments = ["land", "--changes", source, "--landing", landing, "--checkpoint", f"{tmp_path}/cp", "--database", "db"]
    assert main([*arguments, "--drain"]) == {"landed_changes": feed.count()}
    assert main([*arguments, "--idle-exit-seconds", "2"]) == {"landed_changes": 0}
    assert main(["check", "--phase", "cdc", "--landing", landing])["rules"] == 8


def test_replay_feeds_the_batch(spark, tmp_path):
    """Changes of a vendor are landed, replayed, and read as the batch's snapshot."""
    from souklake.__main__ import _snapshot, parse
    from tests.test_changes import change

    source, landing, state = (f"{tmp_path}/{name}" for name in ("changes", "landing", "state"))
    rows = [("0/100", "1", change("I", {"SellerKey": "SELLER-000001", "DaysActive": 3}, table="vendors"), None),
            ("0/101", "1", change("U", {"SellerKey": "SELLER-000001", "DaysActive": 4}, table="vendors"), None)]
    spark.createDataFrame(rows, "lsn string, xid string, raw string, ordinal bigint").write.parquet(source)
    main(["land", "--changes", source, "--landing", landing, "--checkpoint", f"{tmp_path}/cp", "--database", "db", "--drain"])
    arguments = ["replay", "--landing", landing, "--state", state, "--checkpoint", f"{tmp_path}/rp"]
    assert main([*arguments, "--drain", "--purge"]) == {"tables": 1, "purged": 0}
    assert main([*arguments, "--idle-exit-seconds", "2"]) == {"tables": 1, "purged": 0}
    args = parse(["batch", "--bronze", "b", "--lake", "l", "--state", state])
    assert [r["DaysActive"] for r in _snapshot(spark, args)("vendors").collect()] == [4]
