import datetime as dt
import os
import sys
import uuid
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quartermaster.session import get_spark  # noqa: E402
from quartermaster.sources.conform import Star  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the environment when configured (set by
    # get_spark only where unset); each test run writes under its own tag.
    s = get_spark("local[4]", shuffle_partitions=4,
                  extra={"spark.driver.memory": "4g",
                         "quartermaster.run.tag": f"test-{uuid.uuid4().hex[:12]}"})
    yield s
    s.stop()


def D(s):
    return dt.date.fromisoformat(s) if s else None


@pytest.fixture(scope="session")
def golden(spark):
    """FIXTURES.md F2: the golden mini-star."""
    suppliers = spark.createDataFrame(
        [("SUP-001", "Alpha", "North America", "US", 5, 4.5),
         ("SUP-002", "Beta", "Europe", "UK", 10, 3.9),
         ("SUP-003", "Gamma", "Africa", "Kenya", 20, 2.8)],
        "supplier_id string, supplier_name string, region string, country string, "
        "lead_time_days int, reliability_rating double")
    products = spark.createDataFrame(
        [("PROD-001", "Widget", "Packaging", Decimal("10.00"), "SUP-001", 1.0),
         ("PROD-002", "Board", "Electronics Components", Decimal("50.00"), "SUP-002", 0.5),
         ("PROD-003", "Rod", "Raw Materials", Decimal("20.00"), "SUP-003", 9.0)],
        "product_id string, product_name string, category string, unit_cost decimal(12,2), "
        "supplier_id string, weight_kg double")
    po = [("PO-00001", "PROD-001", "SUP-001", "2024-10-05", "2024-10-10", "2024-10-10", 10, "10.00", "delivered"),
          ("PO-00002", "PROD-001", "SUP-001", "2024-11-03", "2024-11-08", "2024-11-12", 20, "10.50", "delivered"),
          ("PO-00003", "PROD-002", "SUP-002", "2024-11-20", "2024-12-01", "2024-11-29", 5, "49.99", "delivered"),
          ("PO-00004", "PROD-002", "SUP-002", "2024-12-10", "2025-01-02", None, 8, "50.00", "in_transit"),
          ("PO-00005", "PROD-003", "SUP-003", "2024-12-15", "2025-01-09", None, 3, "20.00", "delayed"),
          ("PO-00006", "PROD-001", "SUP-001", "2024-10-20", "2024-10-26", None, 100, "9.99", "cancelled")]
    orders = spark.createDataFrame(
        [(o, i + 1, p, s, D(a), D(b), D(c), q, Decimal(u), st) for i, (o, p, s, a, b, c, q, u, st) in enumerate(po)],
        "order_id string, line_number int, product_id string, supplier_id string, order_date date, "
        "expected_delivery_date date, actual_delivery_date date, quantity int, unit_cost decimal(12,2), "
        "status string")
    inv = spark.createDataFrame(
        [(D("2024-11-04"), "PROD-001", "Chicago", 10, 200, 300),
         (D("2024-11-11"), "PROD-001", "Chicago", 150, 200, 300),
         (D("2024-11-11"), "PROD-002", "Atlanta", 60, 50, 0),
         (D("2024-11-11"), "PROD-002", "Chicago", 50, 50, 0),
         (D("2024-11-11"), "PROD-003", "Seattle", 99, 100, 150)],
        "snapshot_date date, product_id string, warehouse string, quantity_on_hand int, "
        "reorder_point int, quantity_on_order int")
    return Star(spark=spark, suppliers=suppliers, products=products, purchase_orders=orders,
                inventory_snapshots=inv, source="golden")


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
