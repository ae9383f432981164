"""The two small dimensions: the label taxonomy (28 rows) and the frameworks (12 rows)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from faultloom.schemas import AXES, FRAMEWORKS, TAXONOMY


class Label(NamedTuple):
    axis: str
    label: str
    definition: str
    derived_from: tuple[str, ...] = ()


# Published definitions and provenance of every label, in published order.
TAXONOMY_ROWS: tuple[Label, ...] = (
    Label("locus", "model", "Failure originates in the LLM itself: hallucination, wrong tool choice, token-limit behavior, or reasoning error.", ("agent_error", "faults_agentic")),
    Label("locus", "agent", "Failure in a single agent's scaffolding: memory loss/duplication, reflection failure, planning loop, misinterpretation of state.", ("agent_error", "agentfail")),
    Label("locus", "framework", "Framework code is at fault: API misuse, breaking changes between versions, documentation desync, or a bug in the framework itself.", ("framework_bugs", "faults_agentic")),
    Label("locus", "workflow", "Orchestration across multiple agents/steps fails: handoff errors, role confusion, deadlock, or coordination-protocol issues.", ("mast", "agentfail")),
    Label("locus", "platform", "Runtime or infrastructure is at fault: timeouts, API quotas, sandbox/env issues, cost overruns, deployment config.", ("agentfail",)),
    Label("locus", "unknown", "Insufficient information to attribute locus. Flagged for review."),
    Label("phase", "planning", "Failure during task decomposition, goal setting, or plan generation.", ("agent_error",)),
    Label("phase", "action", "Failure during tool/function call or environment interaction.", ("agent_error", "mast")),
    Label("phase", "reflection", "Failure during self-assessment, error recovery, or course correction.", ("agent_error",)),
    Label("phase", "memory", "Failure in reading/writing short-term or long-term state.", ("agent_error",)),
    Label("phase", "coordination", "Failure during handoff, message passing, or shared-state access in a multi-agent workflow. Only applies when >1 agent is involved.", ("mast",)),
    Label("phase", "infra", "Failure in setup, teardown, or platform-level lifecycle (not within a step).", ("agentfail",)),
    Label("phase", "unknown", "Phase cannot be determined."),
    Label("symptom", "wrong_output", "Agent produced output but it is incorrect, irrelevant, or hallucinated."),
    Label("symptom", "no_output", "Agent hung, timed out, or exited without producing its expected output."),
    Label("symptom", "cost_overrun", "Agent consumed substantially more tokens/calls/dollars than expected for the task."),
    Label("symptom", "crash", "Exception, traceback, or process termination during execution."),
    Label("symptom", "security", "Prompt injection, data exfiltration, unsafe tool invocation, or policy violation."),
    Label("symptom", "loop", "Non-terminating behavior: repeated tool calls, stuck reasoning, recursive replanning."),
    Label("symptom", "unknown", "Symptom not described in the issue."),
    Label("root_cause", "api_misuse", "Framework API called with wrong arguments, wrong order, or in the wrong state. Most common framework-bug category.", ("framework_bugs",)),
    Label("root_cause", "api_incompatibility", "Breaking change between library versions; works on version A, broken on version B.", ("framework_bugs",)),
    Label("root_cause", "doc_desync", "Documentation disagrees with actual API behavior; user followed docs but got a different result.", ("framework_bugs",)),
    Label("root_cause", "model_limitation", "The underlying model cannot handle this input reliably: context-length, reasoning depth, tool-use format.", ("agent_error",)),
    Label("root_cause", "prompt_issue", "Prompt template or user instructions are ambiguous, contradictory, or insufficient."),
    Label("root_cause", "data_quality", "Input data (retrieved context, tool output, user-provided) is malformed, truncated, or out of distribution."),
    Label("root_cause", "infrastructure", "Network, rate-limit, quota, sandbox, or hardware issue."),
    Label("root_cause", "unknown", "Root cause not identified in the issue."),
)

# Slug, repository, display name and home page of every framework.
FRAMEWORK_ROWS: tuple[tuple[str, str, str, str | None], ...] = (
    ("agno", "agno-agi/agno", "Agno", "https://docs.agno.com"),
    ("autogen", "microsoft/autogen", "AutoGen", "https://microsoft.github.io/autogen/"),
    ("autogpt", "Significant-Gravitas/AutoGPT", "AutoGPT", "https://agpt.co/"),
    ("crewai", "crewAIInc/crewAI", "CrewAI", "https://www.crewai.com/"),
    ("langchain", "langchain-ai/langchain", "LangChain", "https://www.langchain.com/"),
    ("langgraph", "langchain-ai/langgraph", "LangGraph", "https://langchain-ai.github.io/langgraph/"),
    ("letta", "letta-ai/letta", "Letta", "https://www.letta.com/"),
    ("llamaindex", "run-llama/llama_index", "LlamaIndex", "https://www.llamaindex.ai/"),
    ("mastra", "mastra-ai/mastra", "Mastra", "https://mastra.ai/"),
    ("semantic_kernel", "microsoft/semantic-kernel", "Semantic Kernel", "https://learn.microsoft.com/semantic-kernel/"),
    ("smolagents", "huggingface/smolagents", "smolagents", "https://huggingface.co/docs/smolagents"),
    ("swarm", "openai/swarm", "OpenAI Swarm", "https://github.com/openai/swarm"),
)

# The wording around the labels in the prompt prefix.
PROMPT_TITLE = "# Unified Agent-Failure Taxonomy"
PROMPT_INTRO = "You will classify a GitHub issue from an agent framework repository against four orthogonal axes. Each axis is a closed set; pick exactly one label per axis. If an axis cannot be determined from the issue text, return `unknown`."
PROMPT_AXIS_TITLES = {
    "locus": "locus (where the failure manifests)",
    "phase": "phase (which agent-lifecycle stage)",
    "symptom": "symptom (observable manifestation)",
    "root_cause": "root_cause (underlying reason, when identifiable)",
}
PROMPT_RULES = (
    "Output rules:",
    "- Always return one label per axis.",
    "- `confidence` is your overall confidence across all four axes (0.0-1.0).",
    "- `reasoning` is one sentence (<=500 chars) citing what in the issue drove the decision.",
    "- Set `needs_review=true` when the issue does not cleanly fit any existing label, or when confidence<0.6.",
)
PROMPT_DIRECTIVE = "You are a careful, conservative classifier. When in doubt, prefer `unknown` and set `needs_review=true`. Do not invent labels outside the taxonomy."


def taxonomy(spark: SparkSession, rows: Sequence[Label] = TAXONOMY_ROWS) -> DataFrame:
    return spark.createDataFrame(
        [(r.axis, r.label, r.definition, list(r.derived_from)) for r in rows], TAXONOMY
    )


def frameworks(spark: SparkSession, rows: Sequence[tuple] = FRAMEWORK_ROWS) -> DataFrame:
    return spark.createDataFrame(list(rows), FRAMEWORKS)


def framework_slugs() -> tuple[str, ...]:
    return tuple(row[0] for row in FRAMEWORK_ROWS)


def taxonomy_prompt(rows: Sequence[Label] = TAXONOMY_ROWS) -> str:
    """The taxonomy as prompt text. The same rows always give the same bytes."""
    sections = [PROMPT_TITLE, PROMPT_INTRO]
    for axis in AXES:
        entries = (f"- **{r.label}**: {r.definition}" for r in rows if r.axis == axis)
        sections.append("\n".join((f"## Axis: {PROMPT_AXIS_TITLES[axis]}", *entries)))
    sections.append("\n".join(PROMPT_RULES))
    return "\n\n".join(sections)


def system_prompt(rows: Sequence[Label] = TAXONOMY_ROWS) -> str:
    """Prompt text plus the closing directive."""
    return f"{taxonomy_prompt(rows)}\n\n---\n\n{PROMPT_DIRECTIVE}"
