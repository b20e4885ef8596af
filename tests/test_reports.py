"""Report parameters and semantics on the sf0.001 catalogue."""

from pyspark.sql import functions as F

from shelfmark.operators import reports as R
from shelfmark.operators import templates as T


def test_loan_list_status_parameter_filters(cat):
    everything = R.loan_list(cat).count()
    statuses = {r.item_status for r in R.loan_list(cat).select("item_status").distinct().collect()}
    assert statuses and everything > 0
    assert R.loan_list(cat, item_status="Missing").count() == 0  # no loan has that status
    some = sorted(statuses)[0]
    assert R.loan_list(cat, item_status=some).filter(F.col("item_status") != some).count() == 0


def test_loan_list_barcode_parameter(cat):
    one = R.loan_list(cat).select("barcode").first().barcode
    rows = R.loan_list(cat, item_barcode=one).select("barcode").distinct().collect()
    assert [r.barcode for r in rows] == [one]


def test_timestamp_between_dates_excludes_end_day_after_midnight(cat):
    li = cat.derived("loans_items")
    day = li.filter(F.hour("loan_date") > 0).select(F.to_date("loan_date").alias("d")).first().d.isoformat()
    r3 = R.loan_list(cat, start_date="1990-01-01", end_date=day, patron_group="Student")
    assert r3.filter(F.to_date("loan_date") == F.lit(day).cast("date")).count() == 0
    # R6 compares calendar dates: a day on which a counted loan was made, taken as both ends, has it.
    r6_loans = (li.filter((F.col("material_type_name") == "DAYUSE-ITEM") & (F.hour("loan_date") > 0))
                .join(cat.derived("items_holdings_instances").select("item_id", "instance_id"), "item_id")
                .join(cat.derived("instance_statistical_codes").filter(F.col("statistical_code_name") == "Laptop"), "instance_id"))
    on = r6_loans.select(F.to_date("loan_date").alias("d")).first().d.isoformat()
    r6 = R.location_checkout_counts(cat, start_date=on, end_date=on)
    assert r6.agg(F.sum("count_of_loans")).first()[0] == r6_loans.filter(F.to_date("loan_date") == F.lit(on).cast("date")).count() > 0


def test_item_link_requires_barcode(cat):
    assert R.item_link(cat, None).count() == 0
    assert R.item_link(cat, "30000000000010").first().link.endswith(">30000000000010</a>")


def test_subject_search_without_subject_returns_nothing(cat):
    assert R.subject_search(cat, None).count() == 0


def test_inventory_search_without_subject_keeps_everything_in_range(cat):
    everything = R.inventory_search(cat, sort=False).count()
    assert everything == R.inventory_search(cat, subject=None, sort=False).count() > 0


def test_checkouts_and_renewals_are_not_swapped(cat):
    row = (R.inventory_search(cat, sort=False).filter(F.col("total_checkouts") > 0)
           .orderBy("item_barcode").first())
    item = cat.flat("item").filter(F.col("barcode") == row.item_barcode).select("id").first().id
    loans = cat.flat("loan").filter(F.col("item_id") == item)
    assert row.total_checkouts == loans.count()
    assert row.total_renewals == loans.agg(F.sum("renewal_count")).first()[0]


def test_fee_range_is_inclusive_and_text_has_two_decimals(cat):
    rows = R.fee_balances(cat, min_fee="100000", max_fee="200000").collect()
    assert rows and all(100000 <= float(r.fee_balance) <= 200000 for r in rows)
    assert all(len(r.fee_balance.split(".")[1]) == 2 for r in rows)


def test_semester_loans_hotspot_excludes_storage(spark):
    """The rule drops items whose home location is Storage, 'All' keeps them: sf0.01 has such rows."""
    from shelfmark.sources import Catalogue

    cat = Catalogue.cached(spark, "/root/testdata/sf0.01")
    home = cat.flat("holdings_record").selectExpr("id AS holdings_id", "permanent_location_id AS location_id")
    names = cat.derived("locations_libraries").select("location_id", "location_name")
    items = cat.doc("item").selectExpr("j.barcode AS item_barcode", "holdingsrecordid AS holdings_id")
    stored = items.join(home, "holdings_id").join(names, "location_id").where("location_name = 'Storage'").select("item_barcode")
    everything = R.semester_loans(cat).where("subtype = 'Hotspot'")
    hotspot = R.semester_loans(cat, subtype="Hotspot")
    assert everything.join(stored, "item_barcode", "left_semi").count() > 0
    assert hotspot.join(stored, "item_barcode", "left_semi").count() == 0
    assert sorted(map(repr, hotspot.collect())) == sorted(map(repr, everything.join(stored, "item_barcode", "left_anti").select(*hotspot.columns).collect()))


def test_item_notes_template_groups_per_item(cat):
    df = T.item_notes(cat)
    assert df.count() == df.select("item_id").distinct().count()


def test_call_number_list_open_end_equals_wide_end(cat):
    a = R.call_number_list(cat, "A", sort=False)
    b = R.call_number_list(cat, "A", "ZZZZZZ", sort=False)
    assert a.count() == b.count() > 0
    assert R.call_number_list(cat, "QA", "QA 3", sort=False).filter(
        ~F.col("call_number").between("QA", "QA 3")).count() == 0


def test_none_means_all_for_rule_parameters(cat):
    assert R.item_details(cat, service_point=None, material_type=None).count() == R.item_details(cat).count()


def test_item_details_status_filter(cat):
    rows = R.item_details(cat, item_status="Missing").select("item_status").distinct().collect()
    assert [r.item_status for r in rows] == ["Missing"]


def test_publication_date_source_parameter(cat):
    dates = {r.instance_id: r.pub_date for r in T.publication_date(cat, "dates").collect()}
    period = {r.instance_id: r.pub_date for r in T.publication_date(cat, "publicationPeriod").collect()}
    assert dates.keys() == period.keys() and all(1950 <= int(d) <= 2010 for d in dates.values())
    assert all(1900 <= int(p) <= 1953 and p < dates[i] for i, p in period.items())


def _is_sorted(rows, *keys):
    """Each key is (column, descending); NULLs last ascending and first descending."""
    def rank(row):
        out = []
        for column, down in keys:
            value = row[column]
            if isinstance(value, str):
                value = tuple(value.encode()) if not down else tuple(-b for b in value.encode()) + (1,)
            elif value is not None and down:
                value = -value
            out.append((value is None) != down)
            out.append(value if value is not None else ())
        return out

    ranks = [rank(r) for r in rows]
    return len(ranks) > 1 and ranks == sorted(ranks)


def test_reports_come_sorted(cat):
    from decimal import Decimal

    assert _is_sorted(R.call_number_list(cat, "A").collect(), ("call_number", False), ("barcode", False))
    assert _is_sorted(R.inventory_search(cat).collect(), ("call_number", False), ("item_barcode", False))
    assert _is_sorted(R.location_checkout_counts(cat).collect(), ("campus_lab", False), ("count_of_loans", True))
    assert _is_sorted(R.semester_loans(cat).collect(), ("item_barcode", False))
    fees = [{**r.asDict(), "fee_balance": Decimal(r.fee_balance)} for r in R.fee_balances(cat).collect()]
    assert _is_sorted(fees, ("fee_date", True), ("username", False), ("fee_balance", True))


def test_rows_without_a_partner(cat):
    """A location without service point, two locations of one name, items that were never lent."""
    home = cat.flat("holdings_record").join(cat.derived("locations_libraries").where("NOT service_point_found").selectExpr("location_id AS permanent_location_id"),
                                            "permanent_location_id")
    barcodes = {r.j.barcode for r in cat.doc("item").join(home.selectExpr("id AS holdingsrecordid"), "holdingsrecordid").collect()}
    assert barcodes and not barcodes & {r.item_barcode for r in R.item_details(cat).collect()}
    assert {0} == {r.total_checkouts for r in R.inventory_search(cat).collect() if int(r.item_barcode[1:]) % 50 == 47}
    assert "Annex General" in {
        r.campus_lab for r in R.location_checkout_counts(cat).collect()}


def test_text_configuration_parameter(cat):
    # 'widgets' stems to the subject word 'widget' under 'english' only.
    english = R.inventory_search(cat, subject="widgets", sort=False).count()
    simple = R.inventory_search(cat, subject="widgets", config="simple", sort=False).count()
    assert english > 0 and simple == 0
    assert R.inventory_search(cat, subject="widget", config="simple", sort=False).count() == english
