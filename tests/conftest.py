import os
import random
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def blobs_outliers(spark):
    """Three tight blobs and five far rows, ids 300 to 304."""
    rng = random.Random(1)
    rows = []
    for i in range(300):
        cx, cy, label = [(0, 0, "a"), (10, 0, "b"), (0, 10, "c")][i % 3]
        rows.append((i, cx + rng.gauss(0, 0.3), cy + rng.gauss(0, 0.3), label))
    for i in range(5):
        rows.append((300 + i, [0.0, 10.0, 0.0][i % 3] + 4.0, [0.0, 0.0, 10.0][i % 3] + 4.0 + i / 10, "abc"[i % 3]))
    return spark.createDataFrame(rows, "id long, x double, y double, label string")


@pytest.fixture(scope="session")
def mixed_net(spark):
    """Strings and numbers, one of them constant; the label follows the protocol."""
    rng = random.Random(2)
    rows = []
    for i in range(400):
        proto = rng.choice(["tcp", "tcp", "udp", "icmp"])
        rows.append((i, proto, rng.choice("xyz"), rng.choice("SF"), rng.random(), rng.random() * 9, 7.0, proto.upper()))
    schema = "id long, protocol_type string, service string, flag string, a double, b double, c double, label string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def linear_target(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        a, b = rng.uniform(-5, 5), rng.uniform(-5, 5)
        rows.append((i, a, b, 3 * a - 2 * b + 5 + rng.gauss(0, 0.1)))
    return spark.createDataFrame(rows, "id long, a double, b double, y double")


@pytest.fixture(scope="session")
def binary_numeric(spark):
    """Eight numbers; the outcome is a threshold on Glucose, which has fewer values than bins."""
    rng = random.Random(4)
    names = ["Pregnancies", "Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI",
             "DiabetesPedigreeFunction", "Age"]
    rows = []
    for i in range(400):
        values = [rng.randint(0, 17), rng.randrange(50, 200, 10), rng.randint(40, 120), rng.randint(0, 99),
                  rng.randint(0, 800), round(rng.uniform(18, 60), 1), round(rng.uniform(0.1, 2.4), 3),
                  rng.randint(21, 80)]
        rows.append((i, *values, float(values[1] > 125)))
    schema = "id long, " + ", ".join(
        f"{n} {'double' if n in ('BMI', 'DiabetesPedigreeFunction') else 'int'}" for n in names
    ) + ", Outcome double"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def multi_class(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        c = i % 4
        point = [rng.gauss(6.0 if j == c else 0.0, 0.5) for j in range(6)]
        rows.append((i, *point, f"Class_{c + 1}"))
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"f{j} double" for j in range(6)) + ", target string")


@pytest.fixture(scope="session")
def mixed_house(spark):
    """The price follows the zone and the quality."""
    rng = random.Random(6)
    rows = []
    for i in range(500):
        zone, style, roof = rng.choice(["low", "mid", "high"]), rng.choice("pq"), rng.choice("rst")
        quality, area = rng.randint(1, 10), rng.randint(500, 3000)
        price = {"low": 100, "mid": 150, "high": 250}[zone] * 1000 + quality * 10000 + rng.randint(-500, 500)
        rows.append((i, zone, style, roof, quality, area, rng.randint(1950, 2015), rng.randint(0, 3), price))
    schema = ("Id int, Zone string, Style string, Roof string, Quality int, Area int, Year int, Garage int, "
              "SalePrice int")
    return spark.createDataFrame(rows, schema)
