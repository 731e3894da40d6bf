import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from itemloom import Catalog, Index, build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

SHIPS = [
    (301.0, "Bergen", 4100.0, "Aurora", "Holm Lines", ["LAXQ", "LAXR"], [b"hull no. 1"], [12.5, 90.25, 7.0]),
    (302.0, "Gdansk", 880.0, "Wisla Star", "Baltic Freight", ["SPZB"], [b"crew a", b"crew b"], [45.0]),
    (303.0, None, 15250.0, "Meridian", "Okeanos", ["SVTT", "SVTU", "SVTV"], [b"tank"], [310.75]),
    (304.0, "Porto", 2300.0, "Andorinha", "Douro Mar", ["CSAA"], [b"deck", b"keel", b"mast"], [5.5, 6.5]),
    (305.0, "Cork", 640.0, "Selkie", "Lee Trawlers", ["EIQQ"], [b"net"], [1.0, 2.0, 3.0]),
    (306.0, "Bergen", 7700.0, "Nordlys", "Holm Lines", ["LBCD", "LBCE"], [b"hull no. 2"], [60.0]),
]
SHIP_SCHEMA = """ship_id double, harbour string, tonnage double, title string, owner string,
    callsigns array<string>, papers array<binary>, dues array<double>"""


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        app_name="itemloom-tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def catalog(spark):
    found = Catalog(spark)
    found.register_table("ship", spark.createDataFrame(SHIPS, SHIP_SCHEMA), "ship_id")
    harbours = [(11.0, "Bergen", "fish, timber"), (12.0, None, "coal"), (13.0, "Cork", "butter")]
    found.register_table("harbour", spark.createDataFrame(harbours, "pier double, h_name string, trade string"), "pier")
    boxes = [("b1", '["tea",840,false]'), ("b2", '["silk","jade",true,{"kg":3},[1]]'), ("b3", '["rope"]')]
    boxed = spark.createDataFrame(boxes, "box string, goods string").withColumn("goods", F.parse_json("goods"))
    found.register_table("box", boxed, "box")
    layout = '{"open":false,"gate":{"lock":{"brand":"Abus","pins":9},"side":"north"},"bays":31}'
    nested = spark.createDataFrame([("p1", layout), ("p2", layout)], "depot string, layout string")
    found.register_table("depots", nested.withColumn("layout", F.parse_json("layout")), "depot")
    log = [("u1", i, f"e{i}", float(i % 3)) for i in range(10)] + [("u2", i, f"f{i}", 1.0) for i in range(3)] + [("u3", None, "lost", 0.0)]
    visits = spark.createDataFrame(log, "uid string, at int, what string, score double")
    found.register_table("visit-log", visits, "uid", "at", {"by_score": Index("score", "what"), "thin": Index("score", "at", include=())})
    return found


@pytest.fixture
def shuffled(spark):
    """Joins as they run on tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
