"""Explicit read schemas of the JSON documents.

Only the members the reports read are declared; a missing member parses to NULL and a
member of the wrong container type parses to NULL as well.  ``inferSchema`` is never
used: the document shape is a contract, not something to sample.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


def _arr(elem: T.DataType) -> T.ArrayType:
    return T.ArrayType(elem, True)


NAME_DOC = _struct(name=S)

INSTANCE_DOC = _struct(
    title=S,
    catalogedDate=S,
    contributors=_arr(_struct(name=S)),
    identifiers=_arr(_struct(value=S)),
    subjects=_arr(_struct(value=S)),
    publication=_arr(_struct(publisher=S, dateOfPublication=S)),
    dates=_struct(date1=S, date2=S),
    publicationPeriod=_struct(start=S, end=S),
    statisticalCodeIds=_arr(S),
)

HOLDINGS_DOC = _struct(instanceId=S, permanentLocationId=S, callNumber=S)

ITEM_DOC = _struct(
    barcode=S,
    copyNumber=S,
    materialTypeId=S,
    status=_struct(name=S),
    notes=_arr(_struct(itemNoteTypeId=S, note=S)),
    statisticalCodeIds=_arr(S),
    metadata=_struct(createdDate=S),
)

LOCATION_DOC = _struct(name=S, campusId=S, libraryId=S, primaryServicePoint=S)

STATISTICAL_CODE_DOC = _struct(name=S, code=S)

LOAN_DOC = _struct(
    itemId=S,
    userId=S,
    status=_struct(name=S),
    itemStatus=S,
    loanDate=S,
    dueDate=S,
    returnDate=S,
    renewalCount=T.IntegerType(),
    itemEffectiveLocationIdAtCheckOut=S,
)

USER_DOC = _struct(
    barcode=S,
    username=S,
    patronGroup=S,
    personal=_struct(firstName=S, lastName=S, phone=S, email=S),
)

GROUP_DOC = _struct(group=S)

# ``remaining`` is a JSON number; it is parsed as an exact decimal so that 400.50 is
# not turned into the double 400.5.
ACCOUNT_DOC = _struct(
    userId=S,
    itemId=S,
    title=S,
    remaining=T.DecimalType(38, 10),
    metadata=_struct(updatedDate=S),
)

# table name -> (promoted key columns beside the document, document schema)
RAW_TABLES: dict[str, tuple[tuple[str, ...], T.StructType]] = {
    "instance": ((), INSTANCE_DOC),
    "holdings_record": (("instanceid", "permanentlocationid"), HOLDINGS_DOC),
    "item": (("holdingsrecordid", "effectivelocationid", "materialtypeid",
              "permanentloantypeid", "temporaryloantypeid"), ITEM_DOC),
    "location": ((), LOCATION_DOC),
    "loccampus": ((), NAME_DOC),
    "loclibrary": ((), NAME_DOC),
    "service_point": ((), NAME_DOC),
    "material_type": ((), NAME_DOC),
    "loan_type": ((), NAME_DOC),
    "statistical_code": ((), STATISTICAL_CODE_DOC),
    "item_note_type": ((), NAME_DOC),
    "loan": ((), LOAN_DOC),
    "users": ((), USER_DOC),
    "groups": ((), GROUP_DOC),
    "accounts": ((), ACCOUNT_DOC),
}

# Members that hold record ids.  Ids and references are brought to one form when a document is parsed
# (canonical_id), so upper-case or padded values join.
ID_MEMBERS: dict[str, tuple[str, ...]] = {
    "instance": ("statisticalCodeIds",),
    "holdings_record": ("instanceId", "permanentLocationId"),
    "item": ("materialTypeId", "notes.itemNoteTypeId", "statisticalCodeIds"),
    "location": ("campusId", "libraryId", "primaryServicePoint"),
    "loan": ("itemId", "userId", "itemEffectiveLocationIdAtCheckOut"),
    "users": ("patronGroup",),
    "accounts": ("userId", "itemId"),
}

# Members whose text must parse as a type; what does not parse is NULL and is reported by the load.
TYPED_MEMBERS: dict[str, dict[str, str]] = {
    "loan": {"loanDate": "timestamp", "dueDate": "timestamp", "returnDate": "timestamp", "renewalCount": "int"},
    "item": {"metadata.createdDate": "timestamp"},
    "accounts": {"remaining": "decimal(38,10)", "metadata.updatedDate": "timestamp"},
}

# Tables whose ids are joined or grouped by and must be unique (ids of loans and accounts are only counted).
UNIQUE_IDS = tuple(t for t in RAW_TABLES if t not in ("loan", "accounts"))
