import gzip
import os

import pytest
from isoloir.plans.build import read_election
from isoloir.schema import FRANCE_2017, FRANCE_2022
from isoloir.session import session_builder

EXPORT_2017 = """\
Code du département;Département;Commune;Inscrits;Abstentions;% Abs/Ins;Adresse;Code Postal;Coordonnées;Voix
01;Ain;Bourg;1000;205;20,5;1 rue A;01000;46.2, 5.22;7
2A;Corse-du-Sud;Ajaccio;800;300;37,5;NA;20000;41.9,8.7;7
69;Rhône;Lyon;900;100;11,11;x;69001;;7
33;Gironde;Bordeaux;900;100;11,11;2 quai B;33000;44.8,-0.58;7
"""
OFFICIAL_HEADER = (
    "Code du département;Libellé du département;Code de la circonscription;"
    "Libellé de la commune;Code du b.vote;Inscrits;Abstentions;% Abs/Ins\n"
)
OFFICIAL_2017 = (
    OFFICIAL_HEADER
    + """\
75;Paris;1;Paris;101;1200;240;20,00
75;Paris;02;Paris;0205;800;80;10,00
75;Paris;3;Paris;12;500;50;10,00
13;Bouches-du-Rhône;1;Marseille;101;700;70;10,00;x;y
"""
)
GEO = """\
circonscription_code,code_postal,code,geo_adresse,longitude,latitude
75-01,75001,0101,4 place du Louvre 75001 Paris,2.34,48.86
75-02,75002,0205,,2.35,48.87
75-03,75003,0312,1 rue C 75003 Paris,2.36,48.88
13-01,13001,0101,1 rue D 13001 Marseille,5.37,43.29
75-04,,0401,1 rue E 75004 Paris,2.35,48.85
"""
EXPORT_2022 = """\
Code du département;Libellé du département;Libellé de la commune;Inscrits;Abstentions;% Abs/Ins;lib_du_b_vote;location
33;Gironde;Bordeaux;950;190;20;Ecole B;44.8,-0.58
ZA;Guadeloupe;Les Abymes;400;200;50;Ecole G;16.27,-61.5
"""
OFFICIAL_2022 = OFFICIAL_HEADER + "75;Paris;1;Paris;0101;1000;250;25,00\n"

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("shared")
    session = (
        session_builder("tests")
        .master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(scratch))
        # Plans are read as text; do not shorten it.
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def files(tmp_path_factory):
    """The fixture files with CRLF line ends; name -> path."""
    folder = tmp_path_factory.mktemp("raw")
    paths = {}
    for name, text in {
        "export_2017.csv": EXPORT_2017,
        "official_2017.txt": OFFICIAL_2017,
        "geo.csv": GEO,
        "export_2022.csv": EXPORT_2022,
        "official_2022.txt": OFFICIAL_2022,
    }.items():
        data = text.replace("\n", "\r\n").encode("utf-8")
        (folder / name).write_bytes(data)
        paths[name] = str(folder / name)
    with gzip.open(folder / "geo.csv.gz", "wb") as f:
        f.write(GEO.encode("utf-8"))
    paths["geo.csv.gz"] = str(folder / "geo.csv.gz")
    return paths


@pytest.fixture(scope="session")
def stations_2017(spark, files):
    return read_election(
        spark, FRANCE_2017, files["export_2017.csv"], files["official_2017.txt"], files["geo.csv"]
    )


@pytest.fixture(scope="session")
def stations_2022(spark, files):
    return read_election(
        spark,
        FRANCE_2022,
        files["export_2022.csv"],
        files["official_2022.txt"],
        files["geo.csv.gz"],
    )


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def executed_plan(df) -> str:
    """The final adaptive plan, after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def values(spark, *texts, name="x"):
    return spark.createDataFrame([(t,) for t in texts], f"`{name}` string")


__all__ = ["SF_DIR", "executed_plan", "plan_of", "rows", "values"]
