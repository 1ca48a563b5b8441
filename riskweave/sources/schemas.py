"""Declared schemas and relational constraints.

Tables are read with a declared ``StructType`` — never with inference, which
costs an extra pass over every file.  Each table also carries its declared
primary key, NOT NULL columns and foreign keys; the data-quality operators
(``operators.quality``) turn these declarations into violation reports.

Two families are registered:

* the school tables of the original application (bronze CSV layer), and
* the driver's TPC-H-like parquet tables, which the adapters in
  ``plans.adapters`` project onto the same entity roles.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{'_'.join(self.columns)}->{self.parent}"


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default_factory=tuple)

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.schema.fieldNames())


def _f(name: str, dtype: T.DataType, nullable: bool = False) -> T.StructField:
    return T.StructField(name, dtype, nullable)


def _fk(col: str, parent: str, parent_col: str | None = None) -> ForeignKey:
    return ForeignKey((col,), parent, (parent_col or col,))


I, L, D, S, DT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType()
TS = T.TimestampNTZType()

# ---------------------------------------------------------------------------
# School tables (bronze).  Keys are declared LongType so that joins against
# the wider driver keys never need a cast; 0/1 flags and counts are ints.
# Dates are ISO text in the source files and read as DateType.
# ---------------------------------------------------------------------------
SCHOOL: dict[str, TableSpec] = {
    "students": TableSpec("students", T.StructType([
        _f("student_id", L), _f("name", S), _f("birth_date", DT), _f("gender", S),
        _f("race_ethnicity", S), _f("neighborhood", S), _f("distance_km", D),
        _f("transport_access", I), _f("special_needs", I)]), ("student_id",)),
    "guardians": TableSpec("guardians", T.StructType([
        _f("guardian_id", L), _f("student_id", L), _f("guardian_name", S),
        _f("relationship", S), _f("education_level", S), _f("employment_status", S),
        _f("phone_valid", I)]), ("guardian_id",), (_fk("student_id", "students"),)),
    "classes": TableSpec("classes", T.StructType([
        _f("class_id", L), _f("grade_level", S), _f("shift", S), _f("room", S),
        _f("school_year", I)]), ("class_id",)),
    "subjects": TableSpec("subjects", T.StructType([
        _f("subject_id", L), _f("subject_name", S), _f("workload_hours", I)]), ("subject_id",)),
    "teachers": TableSpec("teachers", T.StructType([
        _f("teacher_id", L), _f("teacher_name", S), _f("subject_id", L),
        _f("experience_years", I)]), ("teacher_id",), (_fk("subject_id", "subjects"),)),
    "enrollments": TableSpec("enrollments", T.StructType([
        _f("enrollment_id", L), _f("student_id", L), _f("class_id", L),
        _f("enrollment_date", DT), _f("status", S), _f("dropout_date", DT, True),
        _f("dropout_reason", S, True)]), ("enrollment_id",),
        (_fk("student_id", "students"), _fk("class_id", "classes"))),
    "socioeconomic": TableSpec("socioeconomic", T.StructType([
        _f("student_id", L), _f("family_income_brl", D), _f("household_size", I),
        _f("internet_access", I), _f("receives_social_benefit", I),
        _f("works_after_school", I), _f("food_insecurity_score", I)]), ("student_id",),
        (_fk("student_id", "students"),)),
    "attendance": TableSpec("attendance", T.StructType([
        _f("attendance_id", L), _f("student_id", L), _f("subject_id", L), _f("month", I),
        _f("school_year", I), _f("classes_offered", I), _f("absences", I)]), ("attendance_id",),
        (_fk("student_id", "students"), _fk("subject_id", "subjects"))),
    "grades": TableSpec("grades", T.StructType([
        _f("grade_id", L), _f("student_id", L), _f("subject_id", L), _f("bimester", I),
        _f("school_year", I), _f("grade", D), _f("recovery_exam", I)]), ("grade_id",),
        (_fk("student_id", "students"), _fk("subject_id", "subjects"))),
    "digital_engagement": TableSpec("digital_engagement", T.StructType([
        _f("engagement_id", L), _f("student_id", L), _f("month", I), _f("school_year", I),
        _f("platform_logins", I), _f("homework_submitted", I), _f("messages_to_teacher", I)]),
        ("engagement_id",), (_fk("student_id", "students"),)),
    "interventions": TableSpec("interventions", T.StructType([
        _f("intervention_id", L), _f("student_id", L), _f("intervention_date", DT),
        _f("intervention_type", S), _f("responsible_team", S), _f("result", S)]),
        ("intervention_id",), (_fk("student_id", "students"),)),
}

# ---------------------------------------------------------------------------
# Driver tables (parquet).  Types as Spark reads them; every column of the
# generated files is nullable in the parquet footer, so NOT NULL is declared
# here (nullable=False) only as intent and checked by ``null_counts``.
# ---------------------------------------------------------------------------
DRIVER: dict[str, TableSpec] = {
    "region": TableSpec("region", T.StructType([_f("r_regionkey", I), _f("r_name", S)]),
                        ("r_regionkey",)),
    "nation": TableSpec("nation", T.StructType([
        _f("n_nationkey", I), _f("n_name", S), _f("n_regionkey", I)]), ("n_nationkey",),
        (_fk("n_regionkey", "region", "r_regionkey"),)),
    "customer": TableSpec("customer", T.StructType([
        _f("c_custkey", L), _f("c_name", S), _f("c_nationkey", I), _f("c_acctbal", D),
        _f("c_mktsegment", S)]), ("c_custkey",), (_fk("c_nationkey", "nation", "n_nationkey"),)),
    "supplier": TableSpec("supplier", T.StructType([
        _f("s_suppkey", L), _f("s_name", S), _f("s_nationkey", I), _f("s_acctbal", D)]),
        ("s_suppkey",), (_fk("s_nationkey", "nation", "n_nationkey"),)),
    "part": TableSpec("part", T.StructType([
        _f("p_partkey", L), _f("p_name", S), _f("p_brand", S), _f("p_type", S), _f("p_size", I),
        _f("p_retailprice", D)]), ("p_partkey",)),
    "orders": TableSpec("orders", T.StructType([
        _f("o_orderkey", L), _f("o_custkey", L), _f("o_orderstatus", S), _f("o_totalprice", D),
        _f("o_orderdate", TS), _f("o_orderpriority", S)]), ("o_orderkey",),
        (_fk("o_custkey", "customer", "c_custkey"),)),
    "lineitem": TableSpec("lineitem", T.StructType([
        _f("l_orderkey", L), _f("l_partkey", L), _f("l_suppkey", L), _f("l_linenumber", I),
        _f("l_quantity", D), _f("l_extendedprice", D), _f("l_discount", D), _f("l_tax", D),
        _f("l_returnflag", S), _f("l_linestatus", S), _f("l_shipdate", TS)]),
        ("l_orderkey", "l_linenumber"),
        (_fk("l_orderkey", "orders", "o_orderkey"), _fk("l_partkey", "part", "p_partkey"),
         _fk("l_suppkey", "supplier", "s_suppkey"))),
    "events": TableSpec("events", T.StructType([
        _f("event_id", L), _f("ts", TS), _f("user_id", L), _f("event_type", S), _f("value", D),
        _f("props", S, True)]), ("event_id",), (_fk("user_id", "customer", "c_custkey"),)),
}

REGISTRY: dict[str, TableSpec] = {**SCHOOL, **DRIVER}


def spec(name: str) -> TableSpec:
    try:
        return REGISTRY[name]
    except KeyError as exc:  # pragma: no cover - programming error
        raise KeyError(f"no declared schema for table {name!r}") from exc


def nullable_schema(schema: T.StructType) -> T.StructType:
    """Same fields, all nullable — the form used for *reading*.

    Readers must not trust a NOT NULL declaration (parquet readers and CSV
    in PERMISSIVE mode may yield NULL); the declaration is enforced by the
    ``null_counts`` report instead.
    """
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
