"""HL7v2 messages to rows, as column expressions over one message for each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADMIT, DISCHARGE, RESULT = "ADT^A01", "ADT^A03", "ORU^R01"

# The characters that count as white space at the ends of a message (Unicode white space).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Fewest fields (counting the segment name) a segment must have for its message type to be read.
REQUIRED = {
    ADMIT: {"MSH": 10, "PID": 9, "PV1": 3},
    DISCHARGE: {"MSH": 10, "PID": 6, "PV1": 3},
    RESULT: {"MSH": 10, "PID": 6, "OBR": 3},
}
OBX_REQUIRED = 9

# Message type -> raw table.
ROUTES = {ADMIT: "hl7_admissions", DISCHARGE: "hl7_discharges", RESULT: "hl7_lab_results"}


# One escaped character, not a class: it spares the regex engine on every split.
FIELD, COMPONENT = r"\|", r"\^"


def segment_lines(message: Column) -> Column:
    """Segments of a message as lines."""
    return F.split(F.btrim(message, F.lit(WHITE_SPACE)), "\n", -1)


def fields(line: Column) -> Column:
    return F.split(line, FIELD, -1)


def split_message(message: Column) -> Column:
    """Segments of a message, each as its array of fields."""
    return F.transform(segment_lines(message), fields)


# The first line that starts with ``MSH|``; only a line feed ends a line.
HEADER_LINE = r"(?dm)^MSH[|].*$"


def header_fields(message: Column) -> Column:
    return fields(F.regexp_extract(message, HEADER_LINE, 0))


def control_id(message: Column) -> Column:
    return F.coalesce(F.get(header_fields(message), 9), F.lit(""))


def message_type(message: Column) -> Column:
    return F.coalesce(F.get(header_fields(message), 8), F.lit(""))


def with_header(messages: DataFrame, message: str = "message") -> DataFrame:
    """Messages with their control id and type, empty where the header has none."""
    return messages.withColumns({"control_id": control_id(F.col(message)), "message_type": message_type(F.col(message))})


def with_route(messages: DataFrame) -> DataFrame:
    """The raw table each message belongs to, or ``unknown``; a folder name for a log partitioned by it."""
    tables = F.create_map(*[F.lit(text) for pair in ROUTES.items() for text in pair])
    return messages.withColumn("route", F.coalesce(F.try_element_at(tables, F.col("message_type")), F.lit("unknown")))


def route(messages: DataFrame) -> dict[str, DataFrame]:
    """Messages by raw table, and the ``unknown`` rest; a log partitioned by ``route`` is read folder by folder."""
    if "route" in messages.columns:
        return {name: messages.where(F.col("route") == name) for name in (*ROUTES.values(), "unknown")}
    kind = F.col("message_type")
    frames = {table: messages.where(kind == known) for known, table in ROUTES.items()}
    frames["unknown"] = messages.where(~kind.isin(*ROUTES))
    return frames


def route_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("message_type").agg(F.count("*").alias("n_messages"))


def _segments(messages: DataFrame) -> DataFrame:
    """Fields of the first segment of each kind the parsers read and of all result segments, and the name's parts.

    Lines are chosen by name before they are cut into fields, so other segments cost no split.
    """

    def named(name: str) -> Column:
        return F.filter("_lines", lambda line: line.startswith(f"{name}|") | (line == name))

    firsts = {name.lower(): fields(F.get(named(name), 0)) for name in ("MSH", "PID", "PV1", "OBR")}
    results = {"obx": F.transform(named("OBX"), fields)}
    lines = messages.withColumn("_lines", segment_lines(F.col("message")))
    segments = lines.withColumns({**firsts, **results}).drop("_lines")
    return segments.withColumn("patient_name", F.split(F.get("pid", 5), COMPONENT, -1))


def _complaints(kind: str) -> Column:
    """Why a message cannot be read, or null."""
    reasons = [
        F.when(F.coalesce(F.size(name.lower()), F.lit(-1)) < least, F.lit(f"{name} missing or short"))
        for name, least in REQUIRED[kind].items()
    ]
    if kind == RESULT:
        short = F.exists("obx", lambda segment: F.size(segment) < OBX_REQUIRED)
        reasons.append(F.when(short, F.lit("OBX short")))
    return F.coalesce(*reasons)


def _rows(messages: DataFrame, kind: str, rows: Column, carry: tuple[str, ...]) -> DataFrame:
    """The rows each readable message gives, next to the carried columns of the message.

    The generator also does the filtering: a filter would be pushed below the parse and so repeat it.
    """
    readable = F.when(_complaints(kind).isNull(), rows)
    return _segments(messages).select(F.explode(readable).alias("row"), *carry).select("row.*", *carry)


def rejects(messages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Messages of a known type that lack a segment or field their parser needs, with the reason and carried columns."""
    kind = F.col("message_type")
    reason = F.coalesce(*[F.when(kind == known, _complaints(known)) for known in REQUIRED])
    known = messages.where(kind.isin(*REQUIRED))
    checked = _segments(known).withColumn("reason", reason).where(F.col("reason").isNotNull())
    return checked.select("control_id", "message_type", "reason", "message", *carry)


def _optional(segment: str, index: int) -> Column:
    return F.coalesce(F.get(segment, index), F.lit(""))


def _component(text: Column, index: int) -> Column:
    return F.coalesce(F.get(F.split(text, COMPONENT, -1), index), F.lit(""))


def _patient() -> dict[str, Column]:
    return {
        "message_id": F.get("msh", 9),
        "patient_mrn": F.get("pid", 3),
        "patient_last_name": _optional("patient_name", 0),
        "patient_first_name": _optional("patient_name", 1),
    }


def _origin() -> dict[str, Column]:
    return {"sending_facility": F.get("msh", 3), "message_datetime": F.get("msh", 6)}


def _visit() -> dict[str, Column]:
    return {
        "attending_provider_npi": _component(_optional("pv1", 7), 0),
        "patient_class": F.get("pv1", 2),
        "admit_datetime": _optional("pv1", 44),
    }


def _struct(columns: dict[str, Column]) -> Column:
    return F.struct(*[value.alias(name) for name, value in columns.items()])


def admissions(messages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each ADT^A01 message."""
    person = {"patient_dob": F.get("pid", 7), "patient_gender": F.get("pid", 8)}
    number = {"visit_number": _optional("pv1", 19)}
    row = _struct({**_patient(), **person, **_visit(), **number, **_origin()})
    return _rows(messages, ADMIT, F.array(row), carry)


def discharges(messages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each ADT^A03 message."""
    leave = {"discharge_datetime": _optional("pv1", 45), "visit_number": _optional("pv1", 19)}
    row = _struct({**_patient(), **_visit(), **leave, **_origin()})
    return _rows(messages, DISCHARGE, F.array(row), carry)


def lab_results(messages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each OBX segment of an ORU^R01 message; a message without results gives none."""

    def result(segment: Column) -> Column:
        test = F.get(segment, 3)
        return _struct(
            {
                **_patient(),
                "ordering_provider_npi": _optional("obr", 16),
                "order_number": F.get("obr", 2),
                "test_code": _component(test, 0),
                "test_name": _component(test, 1),
                "result_value": F.get(segment, 5),
                "result_units": F.get(segment, 6),
                "reference_range": F.get(segment, 7),
                "abnormal_flag": F.get(segment, 8),
                "observation_datetime": F.get("msh", 6),
                **_origin(),
            }
        )

    return _rows(messages, RESULT, F.transform("obx", result), carry)


# Raw table -> parser.
PARSERS = {"hl7_admissions": admissions, "hl7_discharges": discharges, "hl7_lab_results": lab_results}


def abnormal_flag(value: Column, reference_range: Column) -> Column:
    """Flag of a numeric result against its ``low-high`` range; null where either is not numeric.

    Fixed values: HH from half a range above the upper bound on, LL from a fifth of a range below the lower bound on.
    """
    bounds = F.split(reference_range, "-")
    low, high = (F.get(bounds, i).try_cast("decimal(18,6)") for i in (0, 1))
    number = value.try_cast("decimal(18,6)")
    width = high - low
    return (
        F.when(number > high, F.when(number >= high + width * F.lit(0.5).cast("decimal(2,1)"), "HH").otherwise("H"))
        .when(number < low, F.when(number <= low - width * F.lit(0.2).cast("decimal(2,1)"), "LL").otherwise("L"))
        .when(number.between(low, high), "N")
    )
