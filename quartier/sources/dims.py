"""Space and municipality dimensions: fixed tables and their file readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's data files.
# Space coordinates, "room_id x y", rooms 1..54.
SPACE_COORDINATES = """
1 21.5 23
2 24.5 20
3 19.5 19
4 22.5 15
5 24.5 12
6 19.5 12
7 22.5 8
8 24.5 4
9 21.5 2
10 19.5 5
11 16.5 3
12 13.5 1
13 12.5 5
14 8.5 6
15 5.5 3
16 1.5 2
17 1.5 8
18 5.5 10
19 3.5 13
20 0.5 17
21 4.5 18
22 1.5 23
23 6 24
24 1.5 30
25 4.5 30
26 7.5 31
27 8.5 26
28 10.5 31
29 12.5 26
30 13.5 31
31 15.5 28
32 17.5 31
33 19.5 26
34 21.5 30
35 24.5 27
36 26.5 31
37 27.5 26
38 30.5 31
39 30.5 26
40 33.5 28
41 36.5 30
42 39.5 30
43 35.5 24
44 40.5 22
45 37.5 19
46 34.5 16
47 39.5 14
48 35.5 10
49 39.5 6
50 38.5 1
51 35.5 4
52 31.5 6
53 28.5 5
54 26.5 2
"""

# Municipality of each room, "room_id,name", rooms 1..54.
ROOM_MUNICIPALITIES = """
1,Bruxelles-Ville
2,Bruxelles-Ville
3,Bruxelles-Ville
4,Schaerbeek
5,Schaerbeek
6,Schaerbeek
7,Etterbeek
8,Etterbeek
9,Etterbeek
10,Ixelles
11,Ixelles
12,Ixelles
13,Saint Gilles
14,Saint Gilles
15,Saint Gilles
16,Anderlecht
17,Anderlecht
18,Anderlecht
19,Molenbeek-St-Jean
20,Molenbeek-St-Jean
21,Molenbeek-St-Jean
22,Koekelberg
23,Koekelberg
24,Koekelberg
25,Berchem-Ste-Agathe
26,Berchem-Ste-Agathe
27,Berchem-Ste-Agathe
28,Ganshoren
29,Ganshoren
30,Ganshoren
31,Jette
32,Jette
33,Jette
34,Evere
35,Evere
36,Evere
37,Woluwé-St-Pierre
38,Woluwé-St-Pierre
39,Woluwé-St-Pierre
40,Auderghem
41,Auderghem
42,Auderghem
43,Watermael-Boitsfort
44,Watermael-Boitsfort
45,Watermael-Boitsfort
46,Uccle
47,Uccle
48,Uccle
49,Forest
50,Forest
51,Forest
52,Woluwé-St-Lambert
53,Woluwé-St-Lambert
54,St Josse-ten-Noode
"""

# Municipality names by municipality id, "id: name", ids 1..19.
MUNICIPALITY_NAMES = """
1: Bruxelles-Ville
2: Schaerbeek
3: Etterbeek
4: Ixelles
5: Saint Gilles
6: Anderlecht
7: Molenbeek-St-Jean
8: Koekelberg
9: Berchem-Ste-Agathe
10: Ganshoren
11: Jette
12: Evere
13: Woluwé-St-Pierre
14: Auderghem
15: Watermael-Boitsfort
16: Uccle
17: Forest
18: Woluwé-St-Lambert
19: St Josse-ten-Noode
"""
# ---------------------------------------------------------------------------


def space_rows() -> list[tuple[int, float, float]]:
    out = []
    for line in SPACE_COORDINATES.strip().splitlines():
        i, x, y = line.split()
        out.append((int(i), float(x), float(y)))
    return out


def room_municipality_rows() -> list[tuple[int, str]]:
    return [(int(a), b.strip()) for a, b in
            (line.split(",", 1) for line in ROOM_MUNICIPALITIES.strip().splitlines())]


def municipality_name_rows() -> list[tuple[int, str]]:
    return [(int(a), b.strip()) for a, b in
            (line.split(":", 1) for line in MUNICIPALITY_NAMES.strip().splitlines())]


SPACE_SCHEMA = T.StructType([T.StructField("room_id", T.IntegerType()),
                             T.StructField("x", T.DoubleType()),
                             T.StructField("y", T.DoubleType())])
ROOM_MUNI_SCHEMA = T.StructType([T.StructField("room_id", T.IntegerType()),
                                 T.StructField("municipality_name", T.StringType())])
MUNI_SCHEMA = T.StructType([T.StructField("mun", T.IntegerType()),
                            T.StructField("name", T.StringType())])


def space_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(space_rows(), SPACE_SCHEMA)


def room_municipality_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(room_municipality_rows(), ROOM_MUNI_SCHEMA)


def municipality_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(municipality_name_rows(), MUNI_SCHEMA)


# -- file readers ------------------------------------------------------------

def read_space_file(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace separated ``id x y`` lines -> (room_id, x, y)."""
    f = F.split(F.trim(F.col("value")), r"\s+")
    return (spark.read.text(path)
            .filter(F.trim(F.col("value")) != "")
            .select(F.get(f, 0).cast("int").alias("room_id"),
                    F.get(f, 1).cast("double").alias("x"),
                    F.get(f, 2).cast("double").alias("y")))


def read_room_municipality_file(spark: SparkSession, path: str) -> DataFrame:
    """``id,name`` lines -> (room_id, municipality_name); names are trimmed."""
    return (spark.read.schema("room_id int, municipality_name string").csv(path)
            .select("room_id", F.trim("municipality_name").alias("municipality_name")))


def read_municipality_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The brace-wrapped ``id: name,`` listing (not valid JSON) -> (mun, name)."""
    rx = r"^\s*(\d+)\s*:\s*(.*?)\s*,?\s*$"
    v = F.col("value")
    return (spark.read.text(path).filter(v.rlike(rx))
            .select(F.regexp_extract(v, rx, 1).cast("int").alias("mun"),
                    F.regexp_extract(v, rx, 2).alias("name")))
