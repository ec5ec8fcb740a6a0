"""A recorded response of the reference system, recomputed from its catalog."""

import pytest
from pyspark.sql import functions as F

from marquee import schema
from marquee.operators import content
from marquee.plans.recommend import ServingTables, recommend, recommend_nested

# The demo catalog
# (id, title, type, genres, actors, director, synopsis, year, rating, regions).
CATALOG = """
m001|Shadow Protocol|movie|thriller,crime|Ava Cross, Liam Hart|Noah Kent|An analyst uncovers a conspiracy spanning intelligence agencies.|2024|PG-13|GLOBAL,UK,ZA,US
m002|Neon District|series|sci-fi,action|Mila Ray, Omar Stone|Zane Yu|Detectives pursue synthetic criminals in a vertical megacity.|2025|PG-13|GLOBAL,UK,ZA,US
m003|Kitchen Kings|series|comedy,drama|Nia Banks, Theo Reed|Sara Cole|A struggling restaurant becomes the center of a family power struggle.|2023|PG|GLOBAL,UK,ZA
m004|Savannah Unit|movie|action,adventure|Daniel Khoza, Jada Mills|Priya Ndlovu|Elite responders cross borders to stop an ecological disaster.|2022|PG-13|GLOBAL,ZA,US
m005|Velvet Court|series|romance,drama|Ana Flores, Marcus Webb|Helen Moore|Rival lawyers fall in love while battling a corporate dynasty.|2024|PG-13|GLOBAL,UK,ZA,US
m006|Orbit Nine|movie|sci-fi,thriller|Ravi Cole, Elena North|Mina Park|A damaged station AI may be the crew's only hope of survival.|2026|PG-13|GLOBAL,UK,ZA,US
m007|Harbor Files|series|crime,mystery|Tessa Gray, Joel Prince|Nina Vargas|Cold cases reopen when a port city digitizes decades of records.|2021|PG-13|GLOBAL,UK,ZA
m008|Laugh Track Hotel|series|comedy|Ivy Price, Ben Moss|Luca Dean|Hotel staff navigate chaos when their workplace becomes a reality show.|2020|PG|GLOBAL,UK,ZA,US
m009|The Last Pitch|movie|sports,drama|Chris Dale, Faith Morgan|Eli Turner|An aging coach assembles one final team from rejected talent.|2025|PG|GLOBAL,UK,ZA,US
m010|Cipher Garden|movie|mystery,thriller|Ari Vale, Sora Chen|Imani Ford|A botanist finds hidden messages encoded in genetically edited flowers.|2026|PG-13|GLOBAL,UK,ZA,US
m011|Gold Reef Stories|series|history,drama|Nomsa Dube, Peter Hall|Kabelo Sithole|Three families build fortunes and rivalries in a mining boomtown.|2023|PG|GLOBAL,ZA,UK
m012|Planet Bites|series|documentary,food|Leah Singh|Marco Bell|A chef travels the world to document the science behind iconic dishes.|2022|G|GLOBAL,UK,ZA,US
"""
# Recent titles of the recorded response, newest first.
RECENT = ["m006", "m003", "m007", "m010", "m011", "m012", "m002", "m008", "m001", "m005"]


@pytest.fixture(scope="module")
def tables(spark):
    rows = []
    for line in CATALOG.strip().splitlines():
        i, title, kind, genres, actors, director, synopsis, year, rating, regions = line.split("|")
        rows.append((i, title, kind, genres, actors, director, synopsis, "en", int(year), rating, regions, True, None))
    items = spark.createDataFrame(rows, schema.ITEMS)
    seen = [item for item in ("m001", "m003", "m004", "m005", "m006", "m007", "m008", "m010", "m011", "m012")]
    neighbors = content.content_neighbors(content.item_corpus(items))
    return ServingTables(
        users=spark.createDataFrame([("u001", "UK", "en", "PG-13", None)], schema.USERS),
        items=items,
        recent=spark.createDataFrame([("u001", item, n) for n, item in enumerate(RECENT, 1)], "user_id string, item_id string, position int"),
        watched=spark.createDataFrame([("u001", item) for item in seen], "user_id string, item_id string"),
        affinity=spark.createDataFrame([("u001", "sci-fi", 9.1), ("u001", "drama", 6.9)], "user_id string, genre string, affinity double")
        .withColumn("affinity", F.col("affinity").cast("decimal(18,6)")),
        neighbors=neighbors,
        trending=spark.createDataFrame([], schema.TRENDING),
        versions=spark.createDataFrame([], schema.MODEL_VERSIONS),
    )


def test_recorded_response(tables):
    rows = {row["item_id"]: row.asDict() for row in recommend(tables).collect()}
    assert set(rows) == {"m002", "m009"}
    expected = {
        "m002": dict(score=0.2643, reason="genre_bonus", collaborative=0.0, content=0.4341, session=0.343,
                     trending=0.0, freshness=0.8333, genre_bonus=0.91, position=1),
        "m009": dict(score=0.1771, reason="freshness", collaborative=0.0, content=0.4039, session=0.0,
                     trending=0.0, freshness=0.8333, genre_bonus=0.69, position=2),
    }
    for item, values in expected.items():
        assert {name: rows[item][name] for name in values} == values


def test_every_title_gets_eight_content_neighbors(tables):
    counts = tables.neighbors.groupBy("source_item_id").count().collect()
    assert len(counts) == 12 and {row["count"] for row in counts} == {8}
    assert tables.neighbors.filter("score = 0").count() > 0


def test_nested_document(tables):
    document = recommend_nested(tables, context="home").first()
    assert document["model_version"] == "untrained" and document["context"] == "home"
    assert document["recent_items"] == RECENT
    first = document["recommendations"][0]
    assert first["item_id"] == "m002" and first["genres"] == ["sci-fi", "action"]
    assert first["components"]["session"] == 0.343
