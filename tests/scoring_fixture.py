"""The hand-checked scoring fixture: matrix rows, zone pairs and expected pairs."""

from pyspark.sql import functions as F

from parcelmatch.functions.codes import text_to_bits
from parcelmatch.functions.text import number

MATRIX = [
    (1, "78701", 1, "30.2672", "-97.7431", "H1", "1010", 1990.0, 1500.0, 6000.0, 2.0, 3.0, 1500.0, 1990.0),
    (2, "78701", 0, "30.2700", "-97.7400", "H1", "1011", 2000.0, 2000.0, 7000.0, None, None, None, None),
    (3, "78702", 1, "30.2600", "-97.7200", "H2", "0010", 1980.0, 1000.0, 5000.0, 1.0, 2.0, 1000.0, 1980.0),
    (4, "78704", 1, "30.2400", "-97.7700", None, "1110", None, 1200.0, None, 2.5, 3.0, 1250.0, 1995.0),
    (5, "78731", 0, "30.3500", "-97.7600", "H3", "0000", 2010.0, 3000.0, 9000.0, None, None, None, None),
    (6, "78701", 0, " USA", "-97.7431", None, "1010", 1995.0, 1500.0, 6000.0, None, None, None, None),
]
COLUMNS = (
    "prop_id bigint, zone string, listing int, lat_text string, lon_text string, hood_cd string, hamming string, "
    "yr_built double, building_sqft double, land_sqft double, baths double, beds double, floorsize double, yearbuilt double"
)
ZONE_PAIRS = [("78701", "78702"), ("78701", "78704"), ("78731", "78703")]

# search, cand, ham, km, ham', km', euclid, rank, sim, manhattan, rank, sim
EXPECTED = """
1 2 1 0.430499696 0 0 1.767766953 2 0.354166044 4.166666667 2 0.465240642
1 3 2 2.361872945 1 0.545016682 2.102865470 3 0.185334062 5.711683348 3 0.217377003
1 4 2 3.974195356 1 1 1.633503393 1 0.421811772 3.9 1 0.508021390
1 6 1 - 0 - - 4 - - 4 -
2 1 1 0.430499696 0 0 0.485912658 1 1 0.833333333 1 1
2 3 3 2.221019098 1 0.450605225 1.465431511 2 0.506491074 3.117271892 2 0.633592745
2 4 3 4.404087446 1 1 1.689510120 3 0.393594020 3.566666667 3 0.561497326
2 6 2 - 0.5 - - 4 - - 4 -
3 1 2 2.361872945 0 1 2.031009601 2 0.221537054 5.166666667 2 0.304812834
3 2 3 2.221019098 1 0 1.394433378 1 0.542261915 2.666666667 1 0.705882353
3 6 2 - 0 - - 3 - - 3 -
4 1 2 3.974195356 0 0 0.817516565 1 0.832928700 1.9 1 0.828877005
4 2 3 4.404087446 1 1 2.470717395 2 0 7.066666667 2 0
4 6 2 - 0 - - 3 - - 3 -
6 1 1 - 0 - - 1 - - 1 -
6 2 2 - 1 - - 2 - - 2 -
6 3 2 - 1 - - 3 - - 3 -
6 4 2 - 1 - - 4 - - 4 -
"""


def expected_rows():
    rows = []
    for line in EXPECTED.strip().splitlines():
        rows.append([None if x == "-" else float(x) for x in line.split()])
    return rows


def matrix(spark):
    raw = spark.createDataFrame(MATRIX, COLUMNS)
    return raw.withColumns({
        "lat": number(F.col("lat_text")), "lon": number(F.col("lon_text")), "flag_bits": text_to_bits(F.col("hamming")),
    })
