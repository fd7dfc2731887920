"""The knowledge base's tables: columns, keys, references, enums, facets and search fields."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    key: tuple[str, ...] = ("id",)
    required: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    facets: tuple[str, ...] = ()
    search: tuple[str, ...] = ()
    label: str = ""
    json: tuple[str, ...] = ()
    enums: dict[str, tuple] = field(default_factory=dict)
    ranges: dict[str, tuple] = field(default_factory=dict)
    pairs: tuple[tuple[str, str], ...] = ()
    unique: tuple[str, ...] = ()


def _text(names: str) -> str:
    return ", ".join(f"{n} string" for n in names.split())


# The schema of the curated data.
ENTITIES = (
    Table("herbs", "id long, " + _text("name alias category nature flavor toxicity meridian_tropism origin indication bencao_raw commentary raw_path source_repo"), required=("name",), facets=("category", "nature"), search=("name", "alias", "indication", "commentary", "bencao_raw"), label="中药"),
    Table("formulas", "id long, " + _text("name alias source_book chapter six_channel syndrome indication composition dosage contraindication differentiation lesson_ref") + ", is_high_risk int, " + _text("commentary raw_path source_repo"), required=("name",), defaults={"is_high_risk": 0}, facets=("source_book", "six_channel"), search=("name", "syndrome", "indication", "composition", "commentary"), label="方剂"),
    Table("symptoms", "id long, " + _text("name category description first_gateway target_module required_questions differential"), required=("name",), facets=("category",), search=("name", "description", "first_gateway"), label="症状", json=("required_questions", "differential")),
    Table("syndromes", "id long, " + _text("name six_channel eight_principles location core_symptoms key_differentiation representative_formulas contraindication course_ref description"), required=("name",), facets=("six_channel",), search=("name", "description", "core_symptoms"), label="病机"),
    Table("acupoints", "id long, " + _text("name pinyin meridian location indication technique") + ", is_key_point int, " + _text("commentary raw_path"), required=("name",), defaults={"is_key_point": 0}, facets=("meridian",), search=("name", "meridian", "indication"), label="穴位"),
    Table("meridians", "id long, " + _text("name organ type flow_direction description"), required=("name",)),
    Table("clinical_cases", "id long, " + _text("case_date patient_id gender age chief_complaint inquiry pulse_diagnosis tongue_diagnosis eye_diagnosis diagnosis acupuncture_rx herbal_rx notes disease_tags raw_path source_repo"), facets=("source_repo",), search=("chief_complaint", "diagnosis", "herbal_rx", "inquiry"), label="医案", json=("disease_tags",)),
    Table("folk_formulas", "id long, " + _text("name disease indication composition usage_info source commentary raw_path"), required=("name",), search=("name", "disease", "commentary"), label="民间方"),
    Table("courses", "id long, name string, order_num int, total_hours double, lesson_count int, " + _text("description key_topics raw_path"), required=("name",)),
    Table("classics", "id long, " + _text("book_name chapter_name chapter_num content annotation") + ", word_count int, raw_path string", required=("book_name",), search=("chapter_name", "content"), label="经典"),
    Table("course_notes", "id long, " + _text("module_name note_type title content") + ", word_count int, " + _text("raw_path source_repo"), required=("module_name",), defaults={"source_repo": "primary"}, facets=("module_name", "note_type")),
    Table("books", "id long, " + _text("title author category content") + ", word_count int, " + _text("format raw_path"), required=("title",), facets=("category", "format")),
    Table("lectures", "id long, " + _text("title speaker lecture_type date_info content") + ", word_count int, raw_path string", required=("title",), facets=("lecture_type",), search=("title", "content"), label="讲座"),
    Table("tianji", "id long, " + _text("title category content") + ", word_count int, raw_path string", required=("title",), facets=("category",)),
    Table("treatment_methods", "id long, " + _text("name category description related_pathomechanism related_herbs related_acupoints raw_path source_repo"), required=("name",), defaults={"source_repo": "primary-kb"}, search=("name", "description", "related_herbs"), label="治法"),
    Table("diagnostic_notes", "id long, " + _text("title note_type content") + ", word_count int, raw_path string", required=("title",)),
)
EDGES = (
    Table("formula_herbs", "formula_id long, herb_id long, role string, dosage_in_formula string, note string", ("formula_id", "herb_id"), references={"formula_id": "formulas", "herb_id": "herbs"}),
    Table("formula_syndromes", "formula_id long, syndrome_id long, relevance string", ("formula_id", "syndrome_id"), references={"formula_id": "formulas", "syndrome_id": "syndromes"}, defaults={"relevance": "primary"}),
    Table("syndrome_symptoms", "syndrome_id long, symptom_id long, is_key int", ("syndrome_id", "symptom_id"), references={"syndrome_id": "syndromes", "symptom_id": "symptoms"}, defaults={"is_key": 0}),
    Table("case_formulas", "case_id long, formula_id long, is_acupuncture int", ("case_id", "formula_id"), references={"case_id": "clinical_cases", "formula_id": "formulas"}, defaults={"is_acupuncture": 0}),
    Table("case_herbs", "case_id long, herb_id long, dosage string, note string", ("case_id", "herb_id"), references={"case_id": "clinical_cases", "herb_id": "herbs"}),
    Table("course_course_notes", "course_id long, note_id long", ("course_id", "note_id"), references={"course_id": "courses", "note_id": "course_notes"}),
)
EVIDENCE_COLUMNS = (
    "id long, subject_type string, subject_id long, relation_type string, object_type string, object_id long, evidence_kind string, "
    "source_type string, source_record_type string, source_record_id string, source_id long, source_path string, field_name string, "
    "evidence_text string, confidence double, extraction_method string, review_status string, dedupe_key string, metadata_json string, created_at timestamp"
)
QUARANTINE_COLUMNS = (
    "id long, source_table string, source_record_id long, source_snapshot string, build_id string, content_hash string, schema_version string, "
    "raw_record_json string, source_repo string, source_path string, original_name string, cleaned_name string, run_id string, reason_code string, "
    "status string, dedupe_key string, quarantined_at timestamp, reviewed_at timestamp, review_note string, metadata_json string"
)
ENTITY_TYPES = {
    "herb": "herbs", "formula": "formulas", "symptom": "symptoms", "syndrome": "syndromes", "acupoint": "acupoints",
    "meridian": "meridians", "clinical_case": "clinical_cases", "folk_formula": "folk_formulas", "course": "courses",
    "classic": "classics", "course_note": "course_notes", "book": "books", "lecture": "lectures", "tianji": "tianji",
    "treatment_method": "treatment_methods", "diagnostic_note": "diagnostic_notes",
}
EVIDENCE_ENUMS = {
    "relation_type": ("source_record", "field_value", "entity_relation", "textual", "merged_from", "normalized_from"),
    "evidence_kind": ("source_record", "explicit", "extracted", "inferred", "model_suggested"),
    "source_type": ("database_row", "markdown", "pdf", "image", "github", "manual"),
    "extraction_method": ("manual", "regex", "llm_assisted", "migration", "etl", "normalization"),
    "review_status": ("pending", "reviewed", "rejected"),
    "subject_type": tuple(ENTITY_TYPES),
}
QUARANTINE_ENUMS = {
    "source_table": (*ENTITY_TYPES.values(), "raw_import"),
    "reason_code": ("descriptive_non_entity", "multiple_entities", "invalid_markdown_parse", "ambiguous_name"),
    "status": ("pending_review", "rejected", "restored", "split"),
}
EVIDENCE = Table(
    "evidence", EVIDENCE_COLUMNS, required=("subject_type", "subject_id", "relation_type", "evidence_kind", "source_type", "evidence_text", "extraction_method", "review_status", "dedupe_key"),
    enums=EVIDENCE_ENUMS | {"object_type": tuple(ENTITY_TYPES), "source_record_type": tuple(ENTITY_TYPES)}, ranges={"confidence": (0.0, 1.0)}, pairs=(("object_type", "object_id"),), unique=("dedupe_key",), json=("metadata_json",),
)
QUARANTINE = Table(
    "ingestion_quarantine", QUARANTINE_COLUMNS, required=("source_table", "source_record_id", "raw_record_json", "run_id", "reason_code", "status", "dedupe_key"),
    enums=QUARANTINE_ENUMS, unique=("dedupe_key",), json=("raw_record_json", "metadata_json"),
)
# Fields that are merged, and fields that tell one evidence row from another.
MERGE_FIELDS = (
    "source_book", "chapter", "alias", "composition", "dosage", "indication",
    "six_channel", "syndrome", "differentiation", "contraindication", "commentary", "lesson_ref",
)
IDENTITY_FIELDS = (
    "subject_type", "subject_id", "relation_type", "object_type", "object_id", "evidence_kind",
    "source_type", "source_record_type", "source_record_id", "source_id", "source_path", "field_name",
)
# Fixed values. Detail relations: entity -> (name, edge, own key, other table, other key, columns of the other, columns of the edge, limit).
RELATIONS = {
    "formulas": (("herbs", "formula_herbs", "formula_id", "herbs", "herb_id", ("id", "name", "nature", "flavor"), ("role",), None),
                 ("syndromes", "formula_syndromes", "formula_id", "syndromes", "syndrome_id", ("id", "name", "six_channel"), (), None)),
    "syndromes": (("formulas", "formula_syndromes", "syndrome_id", "formulas", "formula_id", ("id", "name", "source_book"), (), None),
                  ("symptoms", "syndrome_symptoms", "syndrome_id", "symptoms", "symptom_id", ("id", "name", "category"), (), None)),
    "clinical_cases": (("formulas", "case_formulas", "case_id", "formulas", "formula_id", ("id", "name", "source_book"), (), None),
                       ("herbs", "case_herbs", "case_id", "herbs", "herb_id", ("id", "name", "nature", "flavor"), (), None)),
    "herbs": (("formulas", "formula_herbs", "herb_id", "formulas", "formula_id", ("id", "name", "source_book"), ("role",), None),
              ("cases", "case_herbs", "herb_id", "clinical_cases", "case_id", ("id", "patient_id", "chief_complaint"), (), 20)),
    "symptoms": (("syndromes", "syndrome_symptoms", "symptom_id", "syndromes", "syndrome_id", ("id", "name", "six_channel"), (), None),),
    "courses": (("course_notes", "course_course_notes", "course_id", "course_notes", "note_id", ("id", "title", "note_type", "module_name"), (), None),),
}
STATS_TABLES = tuple(t.name for t in ENTITIES if t.name not in ("meridians", "diagnostic_notes"))
LONG_TEXT = ("content", "commentary", "bencao_raw", "herbal_rx", "notes", "inquiry", "indication", "description")

TABLES = {t.name: t for t in (*ENTITIES, *EDGES, EVIDENCE, QUARANTINE)}


def table(name: str) -> Table:
    """The table's entry; an unknown name is refused before any plan is made."""
    if name not in TABLES:
        raise ValueError(f"unknown table: {name!r}")
    return TABLES[name]


def columns(name: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in table(name).ddl.split(",")]


def column(name: str, c: str) -> str:
    if c not in columns(name):
        raise ValueError(f"unknown column of {name}: {c!r}")
    return c


def referencing(parent: str) -> list[tuple[str, str]]:
    """(table, column) of all references to a table."""
    return [(t.name, c) for t in TABLES.values() for c, p in t.references.items() if p == parent]
