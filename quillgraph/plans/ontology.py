"""How tables become nodes and edges."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class NodeRule:
    """One node label: its source table, key column and properties (name -> column)."""

    label: str
    table: str
    key: str
    properties: dict[str, str] = field(default_factory=dict)
    as_text: tuple[str, ...] = ()
    distinct: bool = False
    drop_keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class EdgeRule:
    """One edge type. ``identity`` names the properties that, with the endpoints, make an edge unique."""

    type: str
    table: str
    src_label: str
    src: str
    dst_label: str
    dst: str
    properties: dict[str, str] = field(default_factory=dict)
    identity: tuple[str, ...] = ()


@dataclass(frozen=True)
class Ontology:
    nodes: tuple[NodeRule, ...]
    edges: tuple[EdgeRule, ...]

    def node(self, label: str) -> NodeRule:
        return next(rule for rule in self.nodes if rule.label == label)

    def edge(self, type: str) -> EdgeRule:
        return next(rule for rule in self.edges if rule.type == type)


def same_as_rule(label: str) -> EdgeRule:
    """Edges between nodes of one label that stand for the same thing; one table per label, since ids differ in type."""
    return EdgeRule(f"SAME_AS_{label.upper()}", "", label, "id_a", label, "id_b", {"confidence": "confidence"})


def co_occurs_rule(label: str = "Diagnosis") -> EdgeRule:
    """Edges between codes that occur together."""
    return EdgeRule("CO_OCCURS_WITH", "", label, "code_a", label, "code_b", {"count": "co_count", "log_count": "log_count"})


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


# Tables as the batch ingest writes them, plus ``concepts`` from the mention extraction. Labels, edge types, column and
# property names are fixed values: they must be those of the data set and of the graph that queries expect.
HOSPITAL = Ontology(
    nodes=(
        NodeRule("Patient", "patients", "subject_id", _same("gender", "dob", "dod", "expire_flag"), ("dob", "dod")),
        NodeRule(
            "Admission",
            "admissions",
            "hadm_id",
            _same("subject_id", "admittime", "dischtime", "admission_type", "diagnosis", "hospital_expire_flag"),
            ("admittime", "dischtime"),
        ),
        NodeRule("Diagnosis", "d_icd_diagnoses", "icd9_code", _same("short_title", "long_title")),
        NodeRule("Procedure", "d_icd_procedures", "icd9_code", _same("short_title", "long_title")),
        NodeRule(
            "Medication",
            "prescriptions",
            "ndc",
            _same("drug", "drug_name_poe", "drug_name_generic", "formulary_drug_cd"),
            distinct=True,
        ),
        NodeRule("LabTest", "d_labitems", "itemid", _same("label", "fluid", "category", "loinc_code")),
        NodeRule("ClinicalNote", "noteevents", "row_id", _same("category", "description")),
        NodeRule("Concept", "concepts", "concept_id", _same("name"), distinct=True, drop_keys=("UNKNOWN",)),
        NodeRule("Caregiver", "caregivers", "cgid", _same("label")),
    ),
    edges=(
        EdgeRule("HAS_ADMISSION", "admissions", "Patient", "subject_id", "Admission", "hadm_id"),
        EdgeRule(
            "HAS_DIAGNOSIS", "diagnoses_icd", "Admission", "hadm_id", "Diagnosis", "icd9_code",
            _same("seq_num"), ("seq_num",),
        ),
        EdgeRule("UNDERWENT", "procedures_icd", "Admission", "hadm_id", "Procedure", "icd9_code"),
        EdgeRule(
            "PRESCRIBED", "prescriptions", "Admission", "hadm_id", "Medication", "ndc",
            _same("dose_val_rx", "dose_unit_rx", "route"),
        ),
        EdgeRule(
            "HAD_LAB_RESULT", "labevents", "Admission", "hadm_id", "LabTest", "itemid",
            {"value": "valuenum", "charttime": "charttime"}, ("charttime",),
        ),
        EdgeRule("DOCUMENTED_IN", "noteevents", "Admission", "hadm_id", "ClinicalNote", "row_id"),
        EdgeRule("MENTIONS", "concepts", "ClinicalNote", "note_id", "Concept", "concept_id", _same("score")),
    ),
)

# The same graph over an order-processing schema: customers are patients, orders admissions, parts diagnoses,
# suppliers medications, order priorities procedures, event types lab tests, documents notes, nations caregivers.
ORDERS = Ontology(
    nodes=(
        NodeRule("Patient", "customer", "c_custkey", {"name": "c_name", "segment": "c_mktsegment", "balance": "c_acctbal"}),
        NodeRule(
            "Admission",
            "orders",
            "o_orderkey",
            {
                "patient": "o_custkey",
                "admitted": "o_orderdate",
                "status": "o_orderstatus",
                "priority": "o_orderpriority",
                "price": "o_totalprice",
            },
            ("admitted",),
        ),
        NodeRule("Diagnosis", "part", "p_partkey", {"title": "p_name", "brand": "p_brand", "kind": "p_type"}),
        NodeRule("Procedure", "orders", "o_orderpriority", distinct=True),
        NodeRule("Medication", "supplier", "s_suppkey", {"drug": "s_name"}, distinct=True),
        NodeRule("LabTest", "events", "event_type", distinct=True),
        NodeRule("ClinicalNote", "documents", "doc_id", {"lang": "lang", "source": "source"}),
        NodeRule("Concept", "concepts", "concept_id", {"name": "name"}, distinct=True, drop_keys=("UNKNOWN",)),
        NodeRule("Caregiver", "nation", "n_nationkey", {"label": "n_name"}),
    ),
    edges=(
        EdgeRule("HAS_ADMISSION", "orders", "Patient", "o_custkey", "Admission", "o_orderkey"),
        EdgeRule(
            "HAS_DIAGNOSIS", "lineitem", "Admission", "l_orderkey", "Diagnosis", "l_partkey",
            {"seq_num": "l_linenumber"}, ("seq_num",),
        ),
        EdgeRule("UNDERWENT", "orders", "Admission", "o_orderkey", "Procedure", "o_orderpriority"),
        EdgeRule(
            "PRESCRIBED", "lineitem", "Admission", "l_orderkey", "Medication", "l_suppkey",
            {"dose": "l_quantity", "route": "l_returnflag"},
        ),
        EdgeRule(
            "HAD_LAB_RESULT", "events", "Admission", "user_id", "LabTest", "event_type",
            {"value": "value", "event_id": "event_id"}, ("event_id",),
        ),
        EdgeRule("DOCUMENTED_IN", "documents", "Admission", "doc_id", "ClinicalNote", "doc_id"),
        EdgeRule("MENTIONS", "concepts", "ClinicalNote", "note_id", "Concept", "concept_id", {"score": "score"}),
    ),
)
