"""What vision models answer: prompts, and responses checked against the contract of a figure's summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators.errors import error
from folio.operators.sections import let

#: Which strategies may render which type of figure.
ALLOWED_STRATEGIES = {
    "decision_algorithm": ("ascii_flow_diagram_with_explanation", "mermaid_diagram_with_explanation", "hierarchical_bullets_with_explanation", "markdown_table_with_explanation"),
    "code_or_pseudocode": ("fenced_code_block",),
    "uml_diagram": ("mermaid_diagram_with_explanation", "ascii_flow_diagram_with_explanation", "plain_text_explanation"),
    "architecture_diagram": ("ascii_flow_diagram_with_explanation", "mermaid_diagram_with_explanation", "hierarchical_bullets_with_explanation", "plain_text_explanation"),
    "data_table": ("markdown_table", "markdown_table_with_explanation"),
    "statistical_plot": ("statistical_plot_extraction", "chart_values_with_explanation"),
    "chart": ("chart_values_with_explanation", "markdown_table_with_explanation", "plain_text_explanation"),
    "mathematical_expression": ("latex_math_with_explanation", "plain_text_explanation"),
    "process_or_workflow": ("numbered_steps_with_explanation", "ascii_flow_diagram_with_explanation", "mermaid_diagram_with_explanation", "markdown_table_with_explanation"),
    "timeline": ("timeline_table", "numbered_steps_with_explanation", "markdown_table_with_explanation"),
    "conceptual_diagram": ("hierarchical_bullets_with_explanation", "ascii_flow_diagram_with_explanation", "plain_text_explanation"),
    "mind_map": ("hierarchical_bullets_with_explanation", "plain_text_explanation"),
    "venn_or_set_diagram": ("set_overlap_with_explanation", "hierarchical_bullets_with_explanation", "plain_text_explanation"),
    "clinical_action_map": ("markdown_table_with_explanation", "hierarchical_bullets_with_explanation", "ascii_flow_diagram_with_explanation"),
    "infographic": ("hierarchical_bullets_with_explanation", "markdown_table_with_explanation", "plain_text_explanation"),
    "illustration": ("illustration_labels_with_explanation", "plain_text_explanation"),
    "screenshot_or_ui": ("ui_structure_with_explanation", "plain_text_explanation"),
    "map": ("plain_text_explanation", "hierarchical_bullets_with_explanation"),
    "decorative": ("decorative_note",),
    "other": ("plain_text_explanation", "hierarchical_bullets_with_explanation", "markdown_table_with_explanation", "fenced_code_block"),
}
LEGIBILITY = ("clear", "partial", "poor")
DOMAINS = ("clinical", "software", "scientific", "financial", "engineering", "legal", "educational")
RETRY_PROMPT = "The previous response was empty.  Convert this figure to Markdown now.  Return ONLY the Markdown — no preamble, no JSON."
USER_PROMPT = "Convert this figure to Markdown now."

STRATEGIES = tuple(dict.fromkeys(s for found in ALLOWED_STRATEGIES.values() for s in found))
FIELDS = {"figure_type": "string", "rendering_strategy": "string", "is_informative": "boolean", "markdown_result": "string", "legibility": "string", "confidence": "double", "document_domain": "string"}
CHOICES = {"figure_type": tuple(ALLOWED_STRATEGIES), "rendering_strategy": STRATEGIES, "legibility": LEGIBILITY, "document_domain": DOMAINS}
SUMMARY = "struct<" + ",".join(f"{k}:{v}" for k, v in FIELDS.items()) + ">"
PROBLEMS = "array<struct<field:string,problem:string>>"


def allowed_strategies(spark: SparkSession) -> DataFrame:
    """figure_type, rendering_strategy: V-1's matrix as a table."""
    return spark.createDataFrame([(t, s) for t, found in ALLOWED_STRATEGIES.items() for s in found], "figure_type string, rendering_strategy string")


def is_allowed(figure_type: Column, strategy: Column) -> Column:
    """Whether a strategy may render a type; false for unknown ones and nulls."""
    matrix = F.create_map(*[x for t, found in ALLOWED_STRATEGIES.items() for x in (F.lit(t), F.array(*map(F.lit, found)))])
    return F.coalesce(F.array_contains(F.try_element_at(matrix, figure_type), strategy), F.lit(False))


def checked(rows: DataFrame, text: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """T-31: rows with summary (a struct, null if anything is wrong), problems (field and what is wrong with it) and error.

    The text must be a JSON object with each of FIELDS and no others but those named in extra. Whole fields are checked first: what
    is missing, of another type, or not among the choices; fields that agree with the contract are then checked with one
    another. The problems come in the order of the fields, those of the whole (field null) first or last.

    Everything is one expression within a generator, below which Spark moves no filter on the error, so that a text is parsed once.
    """

    def read(p):
        kind = lambda name: F.schema_of_variant(F.try_variant_get(p["v"], f"$.{name}", "variant"))
        return F.struct(*[F.struct(kind(k).alias("kind"), F.try_variant_get(p["v"], f"$.{k}", t).alias("value")).alias(k) for k, t in FIELDS.items()])

    def one(p, f, name, of):
        value, sort = f[name]["value"], f[name]["kind"]
        missing = ~F.array_contains(p["keys"], name)
        wrong = F.coalesce(sort == "VOID", F.lit(True)) | value.isNull() | ((sort != "STRING") if of == "string" else sort.rlike("^(OBJECT|ARRAY)"))
        told = F.when(missing, "missing").when(wrong, "type")
        if name in CHOICES:
            told = told.when(~value.isin(*CHOICES[name]), "not_allowed")
        elif name == "markdown_result":
            told = told.when(T.strip(value) == "", "empty")
        elif name == "confidence":
            told = told.when(F.isnan(value) | ~value.between(0, 1), "out_of_range")
        return F.struct(F.lit(name).alias("field"), told.alias("problem"))

    def alone(problem):
        return F.array(F.struct(F.lit(None).cast("string").alias("field"), problem.alias("problem"))).cast(PROBLEMS)

    def by_field(p, f):
        whole = F.when(p["v"].isNull(), "not_json").when(p["keys"].isNull(), "not_an_object")
        unknown = F.transform(F.array_except(p["keys"], F.array(*[F.lit(k) for k in (*FIELDS, *extra)])), lambda k: F.struct(k.alias("field"), F.lit("unexpected").alias("problem")))
        fields = F.filter(F.array(*[one(p, f, k, t) for k, t in FIELDS.items()]), lambda x: x["problem"].isNotNull())
        values = F.struct(*[(T.strip(f[k]["value"]) if k == "markdown_result" else f[k]["value"]).alias(k) for k in FIELDS])
        return F.struct(F.when(whole.isNull(), values).cast(SUMMARY).alias("summary"), F.when(whole.isNotNull(), alone(whole)).otherwise(F.concat(fields, unknown).cast(PROBLEMS)).alias("problems"))

    def together(g):
        s = g["summary"]
        decorative, note = s["figure_type"] == "decorative", s["rendering_strategy"] == "decorative_note"
        told = F.when(decorative & s["is_informative"], "decorative_but_informative").when(decorative & ~note, "decorative_needs_note").when(~decorative & ~s["is_informative"], "informative_mismatch")
        told = told.when(note & ~decorative, "note_needs_decorative").when(~is_allowed(s["figure_type"], s["rendering_strategy"]), "strategy_not_allowed")
        return F.when(F.size(g["problems"]) > 0, g["problems"]).when(told.isNotNull(), alone(told)).otherwise(F.array().cast(PROBLEMS))

    def whole_of(g, problems):
        listed = F.array_join(F.transform(problems, lambda p: F.concat_ws(": ", p["field"], p["problem"])), "; ")
        failed = F.when(F.size(problems) > 0, error("FigureSummarizationError", "the response does not agree with the contract", problems=listed))
        return F.struct(F.when(F.size(problems) == 0, g["summary"]).alias("summary"), problems.alias("problems"), failed.alias("error"))

    parsed = F.struct(F.try_parse_json(text).alias("v"), F.json_object_keys(text).alias("keys"))
    found = let(parsed, lambda p: let(let(read(p), lambda f: by_field(p, f)), lambda g: let(together(g), lambda problems: whole_of(g, problems))))
    rest = [c for c in rows.columns if c not in ("summary", "problems", "error")]
    rows = rows.select(F.inline(F.array(F.struct(*rest, found.alias("found")))))
    return rows.select(*rest, "found.summary", "found.problems", "found.error")


def system_prompt(base: str, addenda: dict[str, str], domain: Column) -> Column:
    """T-26: the base prompt, and below a rule what a domain adds to it; the base alone for a domain without an addendum."""
    added = F.coalesce(*[F.when(domain == k, F.lit(v)) for k, v in addenda.items() if v], F.lit(None)) if addenda else F.lit(None)
    return F.when(added.isNull(), F.lit(base)).otherwise(F.concat(F.lit(f"{base}\n---\n"), added.cast("string"), F.lit("\n")))


def user_prompt(attempt: Column) -> Column:
    """T-26: the first attempt's question, or that of a retry."""
    return F.when(attempt > 1, RETRY_PROMPT).otherwise(USER_PROMPT)
