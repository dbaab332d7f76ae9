"""Names, types and source descriptions of the turnout data model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names of the station table and of the published files.
CODE = "Code du département"
DEPARTMENT = "Libellé du département"
COMMUNE = "Libellé de la commune"
REGISTERED = "Inscrits"
ABSTENTIONS = "Abstentions"
RATE = "Pourcentage_Abstentions"
LATITUDE = "latitude"
LONGITUDE = "longitude"
LABEL = "dénomination complète"
ADDRESS = "Adresse complète"
ELECTION = "election"

RAW_RATE = "% Abs/Ins"
CONSTITUENCY = "Code de la circonscription"
STATION = "Code du b.vote"

STATION_SCHEMA = T.StructType(
    [
        T.StructField(CODE, T.StringType()),
        T.StructField(DEPARTMENT, T.StringType()),
        T.StructField(COMMUNE, T.StringType()),
        T.StructField(REGISTERED, T.IntegerType()),
        T.StructField(ABSTENTIONS, T.IntegerType()),
        T.StructField(RATE, T.DoubleType()),
        T.StructField(LATITUDE, T.DoubleType()),
        T.StructField(LONGITUDE, T.DoubleType()),
        T.StructField(LABEL, T.StringType()),
        T.StructField(ADDRESS, T.StringType()),
    ]
)

# The stored table: the station columns plus its partition column.
STORED_SCHEMA = T.StructType([*STATION_SCHEMA.fields, T.StructField(ELECTION, T.IntegerType())])

# Texts that stand for "no value" in the published files.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "n/a",
    "nan",
    "null",
)


@dataclass(frozen=True)
class SourceSpec:
    """How one delimited file (or folder of files) is read.

    ``columns`` are the required header names, in the order wanted; ``None``
    keeps every column. ``line_sep`` is left to Spark (LF, CRLF and CR all end
    a record) unless a file needs one particular terminator. ``multiline`` allows
    line breaks inside quoted fields; a file of that kind is one scan task, but files
    of more than ``split_above`` bytes together are cut into records by many tasks.
    ``partitions`` spreads the rows after the scan, for files that one task reads.
    ``otherwise`` is the encoding of those files of a folder that are no valid UTF-8.
    """

    separator: str = ";"
    columns: tuple[str, ...] | None = None
    encoding: str = "UTF-8"
    na_tokens: tuple[str, ...] = NA_TOKENS
    line_sep: str | None = None
    multiline: bool = False
    split_above: int = 64 << 20
    partitions: int | None = None
    otherwise: str | None = None


@dataclass(frozen=True)
class ElectionSpec:
    """One election: its three sources and how its export becomes stations."""

    year: int
    export: SourceSpec
    coordinates: str
    address: tuple[str, ...]
    renames: Mapping[str, str] = field(default_factory=dict)
    integer_text: tuple[str, ...] = ()
    # Column names of the published files, here and in the elections below.
    official: SourceSpec = SourceSpec(
        columns=(
            CODE,
            DEPARTMENT,
            CONSTITUENCY,
            COMMUNE,
            STATION,
            REGISTERED,
            ABSTENTIONS,
            RAW_RATE,
        )
    )
    geo: SourceSpec = SourceSpec(
        separator=",",
        columns=(
            "circonscription_code",
            "code_postal",
            "code",
            "geo_adresse",
            "longitude",
            "latitude",
        ),
        # Addresses are quoted and may hold line breaks.
        multiline=True,
    )
    # The department rebuilt from the official results and the geo table.
    rebuilt_department: str = "Paris"
    rebuilt_postal_prefix: str = "75"


FRANCE_2017 = ElectionSpec(
    year=2017,
    export=SourceSpec(
        columns=(
            "Coordonnées",
            CODE,
            "Département",
            "Commune",
            REGISTERED,
            ABSTENTIONS,
            RAW_RATE,
            "Adresse",
            "Code Postal",
        )
    ),
    coordinates="Coordonnées",
    renames={"Département": DEPARTMENT, "Commune": COMMUNE},
    address=("Adresse", COMMUNE, "Code Postal"),
    integer_text=("Code Postal",),
)

FRANCE_2022 = ElectionSpec(
    year=2022,
    export=SourceSpec(
        columns=(
            "location",
            CODE,
            DEPARTMENT,
            COMMUNE,
            REGISTERED,
            ABSTENTIONS,
            RAW_RATE,
            "lib_du_b_vote",
        )
    ),
    coordinates="location",
    address=("lib_du_b_vote", COMMUNE),
)

ELECTIONS = {spec.year: spec for spec in (FRANCE_2017, FRANCE_2022)}
