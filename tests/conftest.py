import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlake import LoadConfig, build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# The registry of the golden feeds (see FIXTURES.md); all names are invented
# but for the envelope and amount columns.
GOLDEN_REGISTRY = {
    "queue_export": ["queueid:bigint", "accountno", "opendate", "lastupdatedate", "note"],
    "cmc_aar_act": ["id", "recordtype", "accountno", "actiondate", "actioncode"],
    "cmc_aar_not": ["accountno", "notedate", "text"],
    "cmc_aar_01": ["accountno", "code"],
    "cmc_wfr_workflowreturnfile": ["accountno", "stepdate", "step"],
    "apf_acctplacementfile": ["accountno", "placementdate", "creditline", "balance"],
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "feedlake-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Landing:
    """Folders of one load, with helpers to drop files and to make its configuration."""

    def __init__(self, root):
        self.root = root
        (root / "first").mkdir()
        (root / "second").mkdir()
        (root / "registry.json").write_text(json.dumps(GOLDEN_REGISTRY))

    def drop(self, name, *lines, source="first", end="\n"):
        path = self.root / source / name
        path.write_bytes("".join(line + end for line in lines).encode())

    def markers(self, day, count=6):
        for i in range(count):
            self.drop(f"M{i}_{day}.mrk")

    def config(self, day="20240115", **changes):
        settings = {
            "sources": {"first": str(self.root / "first"), "second": str(self.root / "second")},
            "registry": str(self.root / "registry.json"),
            "target": str(self.root / "published"),
            "ledger": str(self.root / "ledger"),
            "syncday": day,
            **changes,
        }
        return LoadConfig(**settings)

    def table(self, spark, recordtype, feed=None):
        return spark.read.parquet(str(self.root / "published" / recordtype / (feed or recordtype)))


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path)
