"""Independent DuckDB oracle for every registered query.

The oracle rebuilds the library catalogue straight from the base test tables (part,
customer, lineitem, orders, nation, region) as flat columns and lists -- no JSON
documents, no shared code with the Spark side -- following the integer rules of
FIXTURES.md, and then states each report in plain SQL.  Tables ``region nation
customer supplier part orders lineitem documents ...`` must be registered as views.
"""

from __future__ import annotations


def uid(kind: str, expr: str) -> str:
    return f"('{kind}-0000-4000-8000-' || lpad(CAST({expr} AS VARCHAR), greatest(12, length(CAST({expr} AS VARCHAR)))::INTEGER, '0'))"


PRICE = "1fceb11c-7a89-49d6-8ef0-2a42c58556a2"
PO = "5ec4ca65-aacc-4f16-aa9d-395efd89f850"
STAFF = "86e6410d-4c8b-4853-8054-bd5e563e9760"
CIRCULATION = "5366d4d4-8775-4cf4-a00f-77c82f0ca3bf"
PUBLIC = "b6b35579-ee2b-4973-8e0d-ebc05bab0dab"
OWNERSHIP = "34207e4e-5cd7-4eab-801b-b0326cd5c66a"
INVENTORY_DATE = "e1f34ba3-6d37-462e-878c-17f922b13d93"
INVOICE = "8f99bd3a-706c-45d2-89d8-8eca7fa1c03f"

# Catalogue as CTEs.  Integer keys: pk part/instance/holdings, ik item, ck patron,
# nk location / service point, rk campus / library, code index, mt index.
CATALOGUE = f"""
mt AS (SELECT * FROM (VALUES (0, 'ECONOMY', 'SEM-ITEM'), (1, 'STANDARD', 'SEMEXTEND-ITEM'),
        (2, 'PROMO', 'DAYUSE-ITEM'), (3, 'SMALL', 'BOOK'), (4, 'MEDIUM', 'EBOOK'), (5, 'LARGE', 'AV-ITEM'))
        t(k, p_type, name)),
code AS (SELECT * FROM (VALUES (0, 'Calculator'), (1, 'Hotspot'), (2, 'Laptop'), (3, 'Fiction'),
        (4, 'Nonfiction'), (5, 'Kit')) t(k, name)),
ltype AS (SELECT * FROM (VALUES (0, 'Can circulate'), (1, 'Course reserves'), (2, 'Reading room'),
        (3, 'Short term')) t(k, name)),
grp AS (SELECT * FROM (VALUES (0, 'BUILDING', 'Student'), (1, 'AUTOMOBILE', 'Faculty'), (2, 'FURNITURE', 'Staff'),
        (3, 'HOUSEHOLD', 'Guest'), (4, 'MACHINERY', 'Alumni')) t(k, segment, name)),
ntype AS (SELECT * FROM (VALUES ('{PRICE}', 'Price'), ('{PO}', 'PO Number'), ('{STAFF}', 'Staff Note'),
        ('{CIRCULATION}', 'Circulation Note'), ('{PUBLIC}', 'Public Note'), ('{OWNERSHIP}', 'Ownership'),
        ('{INVENTORY_DATE}', 'Inventory Date'), ('{INVOICE}', 'Invoice'))
        t(id, name)),
loc AS (SELECT n_nationkey AS nk, {uid('a4000000', 'n_nationkey')} AS location_id,
        CASE WHEN n_nationkey = 24 THEN 'Storage' WHEN n_nationkey IN (6, 9) THEN 'Annex General'
             ELSE n_name || CASE n_nationkey % 3 WHEN 0 THEN ' General' WHEN 1 THEN ' CLE' ELSE ' Open Lab' END
        END AS name,
        n_regionkey AS rk, CASE WHEN n_nationkey <> 13 THEN n_name END AS sp_name FROM nation),
campus AS (SELECT r_regionkey AS rk, r_name AS name FROM region),
oi AS (SELECT p_partkey AS pk, {uid('b1000000', 'p_partkey')} AS instance_id, p_name AS title,
        '2019-' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') || '-'
            || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') AS cataloged_date,
        CASE p_partkey % 3 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN [p_brand] ELSE [p_brand, p_type] END AS contributors,
        CASE WHEN p_partkey % 2 = 0
             THEN ['978' || CAST(p_partkey AS VARCHAR), '979' || CAST(p_partkey AS VARCHAR) || ' : pbk $10.00']
             ELSE ['978' || CAST(p_partkey AS VARCHAR)] END AS identifiers,
        CASE WHEN p_partkey % 11 <> 0 THEN list_concat(string_split(p_name, ' '), [p_type]) END AS subjects,
        CASE WHEN p_partkey % 4 <> 0 THEN [p_brand] END AS publishers,
        CAST(1950 + p_size AS VARCHAR) AS pub_year,
        CASE WHEN p_partkey % 2 = 0 THEN CAST(1951 + p_size + p_partkey % 5 AS VARCHAR) END AS pub_later,
        CAST(1900 + p_size AS VARCHAR) AS period_start,
        CASE WHEN p_partkey % 3 = 0 THEN CAST(1902 + p_size AS VARCHAR) END AS period_end,
        CASE WHEN p_partkey % 7 = 0 THEN NULL
             WHEN p_partkey % 2 = 0 THEN [p_partkey % 6, (p_partkey + 3) % 6]
             ELSE [p_partkey % 6] END AS codes,
        p_type, p_size
    FROM part),
oh AS (SELECT pk, {uid('b2000000', 'pk')} AS holdings_id, instance_id, pk % 25 AS home_nk,
        CASE pk % 5 WHEN 0 THEN 'QA ' || CAST(p_size AS VARCHAR) || '.' || CAST(pk AS VARCHAR)
                    WHEN 1 THEN 'HF' || CAST(p_size AS VARCHAR) || ' .' || CAST(pk AS VARCHAR)
                    WHEN 2 THEN 'LAPTOP ' || CAST(pk AS VARCHAR)
                    WHEN 3 THEN 'E ' || CAST(p_size AS VARCHAR) END AS call_number
    FROM oi),
ot0 AS (SELECT oi.pk, oi.pk * 2 + c AS ik, c, oi.p_type FROM oi, (VALUES (0), (1)) cc(c)),
ot AS (SELECT pk, ik, {uid('b3000000', 'ik')} AS item_id, {uid('b2000000', 'pk')} AS holdings_id,
        {uid('b1000000', 'pk')} AS instance_id,
        '3' || lpad(CAST(ik AS VARCHAR), 13, '0') AS barcode, CAST(c + 1 AS VARCHAR) AS copy_number,
        (pk + 7 * c) % 25 AS eff_nk, mt.name AS mt_name,
        ['Available', 'Checked out', 'In transit', 'Missing'][ik % 4 + 1] AS status,
        CASE WHEN ik % 7 <> 0 AND ik % 2 = 0
             THEN [CASE WHEN ik % 4 = 0 THEN '$' ELSE '' END || CAST(ik % 90 + 10 AS VARCHAR) || '.00']
             ELSE []::VARCHAR[] END AS price_notes,
        CASE WHEN ik % 7 = 0 THEN []::VARCHAR[]
             ELSE list_concat(CASE WHEN ik % 3 = 0 THEN ['checked ' || CAST(ik % 4 AS VARCHAR)] ELSE []::VARCHAR[] END,
                              CASE WHEN ik % 6 = 0 THEN ['damaged'] ELSE []::VARCHAR[] END) END AS staff_notes,
        CASE WHEN ik % 7 <> 0 AND ik % 5 = 1 THEN ['PO-' || CAST(ik AS VARCHAR)] ELSE []::VARCHAR[] END AS po_notes,
        CASE WHEN ik % 7 <> 0 AND ik % 8 = 3 THEN ['two hours, ' || CAST(ik % 3 AS VARCHAR)] ELSE []::VARCHAR[] END AS circulation_notes,
        CASE WHEN ik % 7 <> 0 AND ik % 8 = 5 THEN ['ask at the desk'] ELSE []::VARCHAR[] END AS public_notes,
        CASE WHEN ik % 7 <> 0 AND ik % 16 = 9 THEN ['gift'] ELSE []::VARCHAR[] END AS ownership_notes,
        CASE WHEN ik % 7 <> 0 AND ik % 10 = 3 THEN ['2021-0' || CAST(ik % 9 + 1 AS VARCHAR)] ELSE []::VARCHAR[] END AS inventory_notes,
        CASE WHEN ik % 7 <> 0 AND ik % 10 = 7 THEN ['INV ' || CAST(ik AS VARCHAR)] ELSE []::VARCHAR[] END AS invoice_notes,
        CASE WHEN ik % 9 <> 0 THEN ik % 6 END AS code,
        ik % 3 AS plt, CASE WHEN ik % 5 = 0 THEN 3 END AS tlt,
        CAST(DATE '2015-01-01' + CAST(ik % 1000 AS INTEGER) AS TIMESTAMP) + INTERVAL 10 HOUR AS created_date
    FROM ot0 JOIN mt ON mt.p_type = ot0.p_type),
ou AS (SELECT c_custkey AS ck, {uid('c1000000', 'c_custkey')} AS user_id,
        '2' || lpad(CAST(c_custkey AS VARCHAR), 13, '0') AS barcode,
        lower(replace(c_name, '#', '.')) AS username,
        grp.name AS group_name,
        CASE WHEN c_custkey % 10 <> 0 THEN 'First' || CAST(c_custkey AS VARCHAR) END AS first_name,
        CASE WHEN c_custkey % 15 <> 0 THEN 'Last' || CAST(c_custkey AS VARCHAR) END AS last_name,
        '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
        lower(replace(c_name, '#', '.')) || '@example.edu' AS email
    FROM customer LEFT JOIN grp ON grp.segment = c_mktsegment),
ol AS (SELECT {uid('d1000000', 'l_orderkey * 8 + l_linenumber')} AS loan_id,
        l_partkey * 2 + l_linenumber % 2 AS ik, {uid('b3000000', 'l_partkey * 2 + l_linenumber % 2')} AS item_id,
        o_custkey AS ck, {uid('c1000000', 'o_custkey')} AS user_id,
        CASE WHEN l_orderkey % 97 <> 0 THEN l_shipdate + to_hours(l_linenumber) END AS loan_date,
        l_shipdate + to_hours(l_linenumber) + INTERVAL 14 DAY AS due_date,
        CASE WHEN l_linestatus <> 'O' THEN l_shipdate + to_hours(l_linenumber) + INTERVAL 7 DAY END AS return_date,
        CASE WHEN l_linestatus = 'O' THEN 'Open' ELSE 'Closed' END AS status,
        CASE WHEN l_linestatus = 'O' THEN 'Checked out' ELSE 'Available' END AS item_status,
        CAST(trunc(l_quantity) AS INTEGER) % 4 AS renewal_count,
        CASE WHEN l_suppkey % 13 <> 0 THEN l_suppkey % 25 END AS checkout_nk
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE (l_partkey * 2 + l_linenumber % 2) % 50 <> 47),
li AS (SELECT ol.loan_id, ol.item_id, ol.user_id, ot.barcode, ol.item_status, ol.loan_date,
        ol.due_date AS loan_due_date, ol.return_date AS loan_return_date, ol.renewal_count,
        ot.mt_name AS material_type_name, ou.group_name AS patron_group_name,
        {uid('a4000000', 'ot.eff_nk')} AS current_item_effective_location_id,
        cl.name AS current_item_effective_location_name
    FROM ol LEFT JOIN ot ON ot.ik = ol.ik LEFT JOIN ou ON ou.ck = ol.ck LEFT JOIN loc cl ON cl.nk = ot.eff_nk),
ihi AS (SELECT ot.item_id, ot.ik, oi.instance_id, oi.pk, oh.holdings_id, oh.call_number, ot.barcode,
        ot.mt_name AS material_type_name, oi.title, oi.cataloged_date
    FROM ot JOIN oh ON oh.pk = ot.pk JOIN oi ON oi.pk = ot.pk)
"""


# All notes of an item, in document order.
NOTES = ("list_concat(price_notes, list_concat(staff_notes, list_concat(po_notes, list_concat(circulation_notes, "
         "list_concat(public_notes, list_concat(ownership_notes, list_concat(inventory_notes, invoice_notes)))))))")


def q(body: str) -> str:
    return f"WITH {CATALOGUE.strip()}\n{body}"


def _csv(name: str) -> str:
    """array_to_string for a list column, NULL when it has no element."""
    return f"CASE WHEN len({name}) > 0 THEN array_to_string({name}, ', ') END"


ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- templates T1-T11
ORACLE["primary_author"] = q("SELECT instance_id, contributors[1] AS author FROM oi WHERE len(contributors) > 0")
ORACLE["authors"] = q("SELECT instance_id, array_to_string(contributors, ', ') AS authors FROM oi "
                      "WHERE len(contributors) > 0")
ORACLE["identifiers"] = q("SELECT instance_id, array_to_string(identifiers, ', ') AS identifiers FROM oi")
ORACLE["instance_stat_codes"] = q(
    "SELECT u.instance_id, code.name AS instance_stat_codes "
    "FROM (SELECT instance_id, unnest(codes) AS c FROM oi) u JOIN code ON code.k = u.c")
ORACLE["item_stat_codes"] = q(
    "SELECT ot.item_id, code.name AS item_stat_code FROM ot JOIN code ON code.k = ot.code")
ORACLE["item_checkouts"] = q(
    "SELECT item_id, count(*) AS checkouts FROM ol WHERE ik IN (SELECT ik FROM ot) GROUP BY item_id")
ORACLE["item_notes"] = q(
    f"SELECT item_id, array_to_string({NOTES}, ', ') AS notes, {_csv('staff_notes')} AS staff_notes FROM ot "
    f"WHERE len({NOTES}) > 0")
ORACLE["primary_publisher"] = q("SELECT instance_id, publishers[1] AS publisher FROM oi WHERE publishers IS NOT NULL")
ORACLE["publishers"] = q("SELECT instance_id, array_to_string(publishers, ', ') AS publishers FROM oi "
                         "WHERE publishers IS NOT NULL")
ORACLE["publication_date"] = q("SELECT instance_id, greatest(pub_year, pub_later) AS pub_date FROM oi")
ORACLE["subjects"] = q("SELECT instance_id, array_to_string(subjects, ', ') AS subjects FROM oi "
                       "WHERE len(subjects) > 0")

# ---------------------------------------------------------------- flattened tables F1
ORACLE["flatten_loan"] = q(f"""
SELECT loan_id AS id, item_id, user_id, status AS status_name, item_status, loan_date, due_date, return_date,
       renewal_count, CASE WHEN checkout_nk IS NOT NULL THEN {uid('a4000000', 'checkout_nk')} END
           AS item_effective_location_id_at_check_out
FROM ol""")
ORACLE["flatten_item"] = q(f"""
SELECT item_id AS id, barcode, copy_number, {uid('a5000000', 'mt.k')} AS material_type_id, status AS status_name,
       CAST(CAST(created_date AS DATE) AS VARCHAR) || 'T10:00:00.000+00:00' AS metadata_created_date
FROM ot JOIN mt ON mt.name = ot.mt_name""")

# ---------------------------------------------------------------- derived tables D1-D11
ORACLE["derived_loans_items"] = q("SELECT * FROM li")
ORACLE["derived_items_holdings_instances"] = q(
    "SELECT item_id, instance_id, holdings_id, call_number, barcode, material_type_name, title, cataloged_date FROM ihi")
ORACLE["derived_item_ext"] = q(f"""
SELECT ot.item_id, ot.barcode, ot.status AS status_name, ot.created_date,
       {uid('a4000000', 'ot.eff_nk')} AS effective_location_id, loc.name AS effective_location_name
FROM ot LEFT JOIN loc ON loc.nk = ot.eff_nk""")
ORACLE["derived_item_statistical_codes"] = q(f"""
SELECT ot.item_id, 0 AS code_ordinality, {uid('a6000000', 'code.k')} AS statistical_code_id,
       code.name AS statistical_code_name
FROM ot JOIN code ON code.k = ot.code""")
ORACLE["derived_instance_statistical_codes"] = q(f"""
SELECT u.instance_id, u.pos AS code_ordinality, {uid('a6000000', 'code.k')} AS statistical_code_id,
       code.name AS statistical_code_name
FROM (SELECT instance_id, unnest(range(len(codes))) AS pos, unnest(codes) AS c FROM oi) u
JOIN code ON code.k = u.c""")
ORACLE["derived_instance_subjects"] = q("""
SELECT instance_id, pos AS subjects_ordinality, '{"value":"' || s || '"}' AS subjects
FROM (SELECT instance_id, unnest(range(len(subjects))) AS pos, unnest(subjects) AS s FROM oi)""")
ORACLE["derived_instance_publication"] = q("""
SELECT instance_id, 0 AS publication_ordinality, publishers[1] AS publisher, pub_year AS date_of_publication
FROM oi WHERE publishers IS NOT NULL""")
ORACLE["derived_instance_identifiers"] = q("""
SELECT instance_id, unnest(range(len(identifiers))) AS identifier_ordinality, unnest(identifiers) AS identifier
FROM oi""")
_KINDS = [("price_notes", PRICE), ("staff_notes", STAFF), ("po_notes", PO), ("circulation_notes", CIRCULATION), ("public_notes", PUBLIC),
          ("ownership_notes", OWNERSHIP), ("inventory_notes", INVENTORY_DATE), ("invoice_notes", INVOICE)]
_TAGGED = [f"list_transform({column}, lambda x: {{'t': '{kind}', 'note': x}})" for column, kind in _KINDS]
ORACLE["derived_item_notes"] = q(f"""
, n AS (SELECT item_id, flatten([{', '.join(_TAGGED)}]) AS notes FROM ot)
SELECT u.item_id, u.pos AS note_ordinality, u.e.t AS note_type_id, ntype.name AS note_type_name, u.e.note AS note
FROM (SELECT item_id, unnest(range(len(notes))) AS pos, unnest(notes) AS e FROM n) u
LEFT JOIN ntype ON ntype.id = u.e.t""")
# Every line of an order, also those of the items that `ol` leaves out as never lent.
ORACLE["derived_loans_renewal_count"] = q(f"""
SELECT {uid('d1000000', 'l_orderkey * 8 + l_linenumber')} AS loan_id, {uid('b3000000', 'l_partkey * 2 + l_linenumber % 2')} AS item_id,
       CAST(trunc(l_quantity) AS INTEGER) % 4 AS renewal_count
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
ORACLE["derived_locations_libraries"] = q(f"""
SELECT loc.location_id, loc.name AS location_name, {uid('a2000000', 'loc.rk')} AS library_id,
       campus.name AS library_name, {uid('a1000000', 'loc.rk')} AS campus_id, campus.name AS campus_name,
       CASE WHEN loc.nk <> 13 THEN {uid('a3000000', 'loc.nk')} END AS service_point_id, loc.sp_name AS service_point_name,
       campus.rk IS NOT NULL AS library_found, campus.rk IS NOT NULL AS campus_found, loc.nk <> 13 AS service_point_found
FROM loc LEFT JOIN campus ON campus.rk = loc.rk""")

# ---------------------------------------------------------------- reports
ORACLE["loan_list"] = q("""
SELECT user_id, item_id, barcode, item_status, loan_date, loan_due_date, loan_return_date, renewal_count,
       material_type_name
FROM li
WHERE patron_group_name = 'Student'
  AND loan_date BETWEEN TIMESTAMP '2000-01-01 00:00:00' AND TIMESTAMP '2050-01-01 00:00:00'""")

ORACLE["location_checkout_counts"] = q("""
SELECT li.current_item_effective_location_name AS campus_lab, CAST(count(li.loan_id) AS INTEGER) AS count_of_loans
FROM li JOIN ihi ON ihi.item_id = li.item_id
     JOIN (SELECT pk FROM (SELECT pk, unnest(codes) AS c FROM oi) WHERE c = 2) isc ON isc.pk = ihi.pk
WHERE li.material_type_name = 'DAYUSE-ITEM'
  AND CAST(li.loan_date AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2050-01-01'
GROUP BY 1""")

ORACLE["fee_balances"] = q("""
SELECT CAST(o_orderdate AS DATE)::VARCHAR AS fee_date, ou.barcode AS patron_barcode, ou.group_name AS patron_profile,
       ou.username, ou.last_name, ou.first_name, ot.barcode, p.p_name AS item_title,
       CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) AS fee_balance
FROM orders
LEFT JOIN ou ON ou.ck = o_custkey
LEFT JOIN (SELECT l_orderkey, s.ln AS ln, s.pk AS pk FROM (SELECT l_orderkey,
             min(struct_pack(ln := l_linenumber, pk := l_partkey)) AS s FROM lineitem GROUP BY 1)) f
       ON f.l_orderkey = o_orderkey
LEFT JOIN ot ON ot.ik = f.pk * 2 + f.ln % 2
LEFT JOIN part p ON p.p_partkey = f.pk
WHERE CAST(o_totalprice AS DECIMAL(12, 2)) BETWEEN 400.00 AND 1000000.00 AND o_orderkey % 100 <> 89""")

ORACLE["fee_balances_high"] = ORACLE["fee_balances"].replace("BETWEEN 400.00 AND 1000000.00", "BETWEEN 400000.00 AND 450000.00")

ORACLE["instance_subject_list"] = q("""
SELECT instance_id, (SELECT string_agg(DISTINCT lower(x), ', ' ORDER BY lower(x)) FROM unnest(subjects) t(x)) AS subjects
FROM oi WHERE len(subjects) > 0""")

ORACLE["item_link"] = q("""
SELECT '<a href="https://library.example.edu/inventory?filters=staffSuppress.false&qindex=items.barcode&query='
       || barcode || '&segment=items&sort=title">' || barcode || '</a>' AS link
FROM ot WHERE barcode = '30000000000010'""")

_EQUIP = """
SELECT oi.title, ou.barcode AS patron_barcode, ol.status AS loan_status,
       nullif(coalesce(ou.first_name, '') || ' ' || coalesce(ou.last_name, ''), ' ') AS patron_name,
       ot.copy_number, ol.item_status, ol.loan_date, ol.due_date, ot.barcode AS item_barcode,
       hl.name AS home_location, il.name AS current_location, campus.name AS campus_name,
       CASE WHEN len(ot.price_notes) > 0 THEN array_to_string(ot.price_notes, ', ') END AS price,
       CASE WHEN len(ot.po_notes) > 0 THEN array_to_string(ot.po_notes, ', ') END AS po_number,
       CASE WHEN len(ot.staff_notes) > 0 THEN array_to_string(ot.staff_notes, ', ') END AS staff_notes
FROM oi JOIN oh ON oh.pk = oi.pk JOIN ot ON ot.pk = oi.pk
     JOIN ol ON ol.ik = ot.ik
     LEFT JOIN ou ON ou.ck = ol.ck
     JOIN loc hl ON hl.nk = oh.home_nk
     JOIN loc il ON il.nk = ot.eff_nk
     JOIN campus ON campus.rk = il.rk
WHERE oi.codes[1] = 1 AND hl.sp_name IS NOT NULL
  AND ol.loan_date BETWEEN TIMESTAMP '2000-01-01 00:00:00' AND TIMESTAMP '2050-01-01 00:00:00'"""
ORACLE["equipment_checkouts"] = q(_EQUIP)

_ITEM_DETAILS = f"""
SELECT oi.title, oh.call_number,
       array_to_string(list_transform(oi.identifiers, lambda x: regexp_replace(x, ' :.*\\$[0-9]+\\.[0-9][0-9]$', '')), ', ')
           AS identifiers,
       greatest(oi.period_start, oi.period_end) AS publication_date,
       ot.barcode AS item_barcode, hl.name AS holdings_location, il.name AS item_location,
       ot.mt_name AS material_type, hl.sp_name AS service_point, ot.status AS item_status,
       plt.name AS permanent_loan_type, tlt.name AS temporary_loan_type,
       {_csv('ot.circulation_notes')} AS circulation_note, {_csv('ot.public_notes')} AS public_note,
       {_csv('ot.staff_notes')} AS staff_notes, {_csv('ot.ownership_notes')} AS ownership,
       {_csv('ot.price_notes')} AS price, {_csv('ot.inventory_notes')} AS inventory_date,
       {_csv('ot.po_notes')} AS po_number, {_csv('ot.invoice_notes')} AS invoice,
       insc.name AS instance_stat_code, itsc.name AS item_stat_code
FROM oi JOIN oh ON oh.pk = oi.pk JOIN ot ON ot.pk = oi.pk
     JOIN loc hl ON hl.nk = oh.home_nk
     JOIN ltype plt ON plt.k = ot.plt
     LEFT JOIN ltype tlt ON tlt.k = ot.tlt
     JOIN loc il ON il.nk = ot.eff_nk
     LEFT JOIN code insc ON insc.k = oi.codes[1]
     LEFT JOIN code itsc ON itsc.k = ot.code
WHERE hl.sp_name IS NOT NULL"""
ORACLE["item_details"] = q(_ITEM_DETAILS)
ORACLE["item_details_filtered"] = q(_ITEM_DETAILS + """
  AND ot.mt_name = 'SEMEXTEND-ITEM' AND ot.status = 'In transit' AND plt.name = 'Reading room' AND insc.name = 'Hotspot'""")
ORACLE["item_details_places"] = q(_ITEM_DETAILS + """
  AND hl.sp_name = 'NATION_7' AND hl.name = 'NATION_7 CLE' AND il.name = 'NATION_14 Open Lab' AND tlt.name = 'Short term'""")

_SEMESTER = """
SELECT code.name AS subtype, lib.name AS item_library, ot.barcode AS item_barcode, ot.status,
       lo.checkout_library, lo.due_date, lo.user_barcode, lo.name, lo.phone_number, lo.email,
       CASE WHEN len(ot.staff_notes) > 0 THEN array_to_string(ot.staff_notes, ', ') END AS staff_notes
FROM oi JOIN oh ON oh.pk = oi.pk JOIN ot ON ot.pk = oi.pk
     JOIN loc hl ON hl.nk = oh.home_nk
     JOIN campus lib ON lib.rk = hl.rk
     JOIN code ON code.k = oi.codes[1]
     LEFT JOIN (
        SELECT ol.ik, CAST(CAST(ol.due_date AS DATE) AS VARCHAR) AS due_date, ou.barcode AS user_barcode,
               nullif(coalesce(ou.first_name, '') || ' ' || coalesce(ou.last_name, ''), ' ') AS name,
               ou.phone AS phone_number, ou.email, cc.name AS checkout_library
        FROM ol JOIN ou ON ou.ck = ol.ck JOIN loc cl ON cl.nk = ol.checkout_nk JOIN campus cc ON cc.rk = cl.rk
        WHERE ol.status = 'Open') lo ON lo.ik = ot.ik
WHERE {rule}"""
_SEM_RULES = {
    "semester_loans": "(code.name = 'Calculator' AND ot.mt_name = 'SEM-ITEM') OR "
                      "(code.name IN ('Laptop', 'Hotspot') AND ot.mt_name = 'SEMEXTEND-ITEM')",
    "semester_loans_calculator": "code.name = 'Calculator' AND ot.mt_name = 'SEM-ITEM'",
    "semester_loans_hotspot": "code.name = 'Hotspot' AND ot.mt_name = 'SEMEXTEND-ITEM' AND hl.name <> 'Storage'",
    "semester_loans_laptop": "code.name = 'Laptop' AND ot.mt_name = 'SEMEXTEND-ITEM'",
}
for _key, _rule in _SEM_RULES.items():
    ORACLE[_key] = q(_SEMESTER.format(rule=_rule))

ORACLE["semester_loans_library"] = q(_SEMESTER.format(rule=f"({_SEM_RULES['semester_loans']}) AND lib.name = 'EUROPE'"))

# Inventory / subject search: subjects text is the subject values joined by ', '; the
# word tokens are those values split on non-alphanumerics, lower-cased; the query words
# below are written already stemmed.
_SEARCH_COLUMNS = """
SELECT oi.title, campus.name AS campus, oi.contributors[1] AS author, oh.call_number, ot.barcode AS item_barcode,
       {item_status}
       {price} AS item_price,
       ot.mt_name AS item_type, oi.cataloged_date AS date_created,
       greatest({pub}) AS publication_date,
       array_to_string(list_transform(oi.identifiers, lambda x: regexp_replace(x, ' :.*\\$[0-9]+\\.[0-9][0-9]$', '')), ', ')
           AS identifiers,
       hl.name AS home_location, il.name AS current_location,
       coalesce(array_to_string(oi.subjects, ', '), '') AS subjects,
       CAST(coalesce(ls.checkouts, 0) AS INTEGER) AS total_checkouts,
       CAST(coalesce(ls.renewals, 0) AS INTEGER) AS total_renewals,
       oi.publishers[1] AS publisher, insc.name AS instance_stat_code, itsc.name AS item_stat_code
FROM oi JOIN oh ON oh.pk = oi.pk JOIN ot ON ot.pk = oi.pk
     JOIN loc hl ON hl.nk = oh.home_nk
     JOIN loc il ON il.nk = ot.eff_nk
     JOIN campus ON campus.rk = hl.rk
     LEFT JOIN code insc ON insc.k = oi.codes[1]
     LEFT JOIN code itsc ON itsc.k = ot.code
     LEFT JOIN (SELECT ik, count(*) AS checkouts, sum(renewal_count) AS renewals FROM ol GROUP BY ik) ls
         ON ls.ik = ot.ik
"""
_R4_COLS = dict(item_status="ot.status AS item_status,",
                price="'$' || ltrim(coalesce(ot.price_notes[1], '0.00'), '$')",
                pub="oi.pub_year, oi.pub_later")
_R10_COLS = dict(item_status="", price="CASE WHEN len(ot.price_notes) > 0 THEN array_to_string(ot.price_notes, ', ') END",
                 pub="oi.period_start, oi.period_end")
_TOKENS = "list_transform(coalesce(oi.subjects, []::VARCHAR[]), lambda s: lower(s))"


def _has(word: str) -> str:
    return f"list_contains({_TOKENS}, '{word}')"


_LC = "regexp_matches(coalesce(oh.call_number, ''), '^[A-Z]{1,3}\\s*[0-9]')"
_R4_WHERE = "oh.call_number BETWEEN 'A' AND 'ZZZ 9999.999' AND hl.sp_name IS NOT NULL"
ORACLE["inventory_search"] = q(
    _SEARCH_COLUMNS.format(**_R4_COLS)
    # widgets or "small gear" -red  ->  widget | (small <-> gear & !red)
    + f"WHERE {_R4_WHERE} AND ({_has('widget')} OR "
      "(list_position(" + _TOKENS + ", 'small') IS NOT NULL AND "
      + _TOKENS + "[list_position(" + _TOKENS + ", 'small') + 1] = 'gear' AND NOT " + _has('red') + "))")
ORACLE["inventory_search_library"] = q(
    _SEARCH_COLUMNS.format(**_R4_COLS)
    + f"WHERE {_R4_WHERE} AND {_LC} AND NOT regexp_matches(il.name, '(?i)(CLE|Open Lab)')")
ORACLE["inventory_search_cle"] = q(
    _SEARCH_COLUMNS.format(**_R4_COLS)
    + f"WHERE {_R4_WHERE} AND NOT {_LC} AND regexp_matches(il.name, '(?i)(CLE)')")
ORACLE["inventory_search_open_labs"] = q(
    _SEARCH_COLUMNS.format(**_R4_COLS)
    + f"WHERE {_R4_WHERE} AND NOT {_LC} AND regexp_matches(il.name, '(?i)(Open Lab)')")
ORACLE["inventory_search_filtered"] = q(
    _SEARCH_COLUMNS.format(**_R4_COLS)
    + "WHERE oh.call_number BETWEEN 'HF' AND 'QA 3' AND hl.sp_name IS NOT NULL AND campus.name = 'ASIA' AND ot.mt_name = 'BOOK'")
# economies -small  ->  economi & !small   (the part type ECONOMY stems to economi)
ORACLE["subject_search"] = q(
    _SEARCH_COLUMNS.format(**_R10_COLS) + f"WHERE {_has('economy')} AND NOT {_has('small')} AND hl.sp_name IS NOT NULL")

# Items with a call number from 'A' on, every side joined (codes, subjects,
# publication, identifiers, notes, loans), one row per item x code x loan state.
ORACLE["call_number_list"] = q(f"""
, states AS (SELECT DISTINCT item_id, item_status, loan_date, loan_return_date, renewal_count FROM li),
  counts AS (SELECT item_id, count(*) AS n FROM li GROUP BY item_id)
SELECT ot.created_date, loc.name AS effective_location_name, ihi.call_number, ihi.barcode, ihi.title,
       ihi.material_type_name, ihi.cataloged_date, code.name AS statistical_code_name,
       st.item_status, st.loan_date, st.loan_return_date, st.renewal_count,
       CAST(counts.n AS INTEGER) AS total_checkouts,
       (SELECT string_agg(DISTINCT x, ', ' ORDER BY x) FROM unnest(ot.staff_notes) t(x)) AS item_notes,
       (SELECT string_agg(DISTINCT x, ', ' ORDER BY x) FROM unnest(oi.identifiers) t(x)) AS instance_identifiers,
       oi.pub_year AS instance_publication,
       (SELECT string_agg(DISTINCT lower(x), ', ' ORDER BY lower(x)) FROM unnest(oi.subjects) t(x)) AS subjects
FROM ihi JOIN ot ON ot.ik = ihi.ik JOIN oi ON oi.pk = ihi.pk
     LEFT JOIN loc ON loc.nk = ot.eff_nk
     JOIN code ON code.k = ot.code
     JOIN states st ON st.item_id = ihi.item_id
     JOIN counts ON counts.item_id = ihi.item_id
WHERE ihi.call_number >= 'A'
  AND len(oi.subjects) > 0 AND oi.publishers IS NOT NULL
  AND len({NOTES}) > 0""")


ORACLE["call_number_list_range"] = ORACLE["call_number_list"].replace("call_number >= 'A'", "call_number BETWEEN 'QA' AND 'QA 3'")


# ---------------------------------------------------------------- reports with set parameters
ORACLE["loan_list_filtered"] = q("""
SELECT user_id, item_id, barcode, item_status, loan_date, loan_due_date, loan_return_date, renewal_count, material_type_name
FROM li
WHERE patron_group_name = 'Faculty' AND item_status = 'Checked out'
  AND loan_date BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1999-07-02 00:00:00'""")
ORACLE["loan_list_item"] = q("""
SELECT user_id, item_id, barcode, item_status, loan_date, loan_due_date, loan_return_date, renewal_count, material_type_name
FROM li
WHERE patron_group_name = 'Student' AND barcode = '30000000000010'
  AND loan_date BETWEEN TIMESTAMP '1990-01-01 00:00:00' AND TIMESTAMP '2050-01-01 00:00:00'""")
_WHOLE = "BETWEEN TIMESTAMP '2000-01-01 00:00:00' AND TIMESTAMP '2050-01-01 00:00:00'"
ORACLE["equipment_checkouts_filtered"] = q(_EQUIP.replace(
    _WHOLE, "BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '2000-12-31 00:00:00'")
    + " AND hl.sp_name = 'NATION_7' AND ol.status = 'Open'")
ORACLE["location_checkout_counts_range"] = ORACLE["location_checkout_counts"].replace(
    "BETWEEN DATE '2000-01-01' AND DATE '2050-01-01'", "BETWEEN DATE '1998-03-01' AND DATE '1999-03-31'")

# ---------------------------------------------------------------- values the load rejects
ORACLE["load_rejects"] = f"""
SELECT 'loan' AS "table", {uid('d1000000', 'l_orderkey * 8 + l_linenumber')} AS id, 'loanDate' AS member, '00/00/0000' AS text
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE l_orderkey % 97 = 0 AND (l_partkey * 2 + l_linenumber % 2) % 50 <> 47
UNION ALL
SELECT 'accounts', {uid('d2000000', 'o_orderkey')}, 'remaining', 'waived' FROM orders WHERE o_orderkey % 100 = 89"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# Full-text match over documents, 'simple' configuration: tokens are the lower-cased
# alphanumeric runs of the whole text.  Query '"of the" or tion -ing'.
_DOC_TOKENS = "list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
ORACLE["text_match_documents"] = f"""
SELECT doc_id, lang, source, n_chars FROM (
  SELECT doc_id, lang, source, n_chars, {_DOC_TOKENS} AS t FROM documents)
WHERE (' ' || array_to_string(t, ' ') || ' ') LIKE '% of the %'
   OR (list_contains(t, 'tion') AND NOT list_contains(t, 'ing'))"""
# '"of the" tion or ing or "the ing" -tion': each alternative is a conjunction.
ORACLE["text_index_documents"] = f"""
SELECT doc_id, lang, source, n_chars FROM (
  SELECT doc_id, lang, source, n_chars, t, ' ' || array_to_string(t, ' ') || ' ' AS s FROM (
    SELECT doc_id, lang, source, n_chars, {_DOC_TOKENS} AS t FROM documents))
WHERE (s LIKE '% of the %' AND list_contains(t, 'tion'))
   OR list_contains(t, 'ing')
   OR (s LIKE '% the ing %' AND NOT list_contains(t, 'tion'))"""
