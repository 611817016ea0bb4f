"""Catalog sink and descriptions."""

import uuid

from conftest import SF_SMALL

from quartermaster.sources import catalog as C
from quartermaster.sources.conform import load_star


def test_save_table_overwrite_keeps_descriptions(spark, golden):
    ns = C.Namespace(schema=f"qm_t_{uuid.uuid4().hex[:8]}")
    C.ensure_schema(spark, ns)
    for _ in range(2):                         # overwrite drops comments; they are re-applied
        C.save_table(golden.suppliers, ns, "suppliers", C.TABLE_COMMENTS["suppliers"],
                     C.COLUMN_COMMENTS["suppliers"])
    dd = {(r.table_name, r.column_name): r.comment for r in C.data_dictionary(spark, ns).collect()}
    assert dd[("suppliers", "lead_time_days")] == C.COLUMN_COMMENTS["suppliers"]["lead_time_days"]
    assert spark.table(ns.fq("suppliers")).count() == 3


def test_register_star_copies_nothing_and_describes(spark):
    star = load_star(spark, SF_SMALL)
    ns = C.Namespace(schema=f"qm_r_{uuid.uuid4().hex[:8]}")
    C.register_star(star, ns)
    dd = C.data_dictionary(spark, ns).collect()
    assert {r.table_name for r in dd} == {"suppliers", "products", "purchase_orders", "inventory_snapshots"}
    assert spark.table(ns.fq("inventory_snapshots")).count() == star.inventory_snapshots.count()
    assert all(r.table_comment for r in dd)


def test_preview_is_ordered(spark, golden):
    rows = C.preview(golden.purchase_orders, 2, by=["order_id"]).collect()
    assert [r.order_id for r in rows] == ["PO-00001", "PO-00002"]
