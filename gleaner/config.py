"""Run settings: three presets, and YAML files with the same keys."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from typing import Any

# The three presets, with the keys their YAML form uses.
PRESETS: dict[str, dict[str, Any]] = {
    "llama_3_2_instruct": {
        "quality_filters": {
            "min_turns": 1,
            "max_turns": 10,
            "min_tokens_per_turn": 10,
            "max_tokens_per_turn": 3072,
            "min_total_tokens": 50,
            "max_total_tokens": 4096,
            "must_have_roles": ["user", "assistant"],
            "check_for_refusal": True,
            "refusal_patterns": [
                "i'm sorry",
                "i cannot",
                "i am unable",
                "as an ai",
                "i can't help with that",
                "as a large language model",
            ],
            "balanced_conversation_ratio": 0.3,
        },
        "deduplication": {"method": "hashed", "similarity_threshold": 0.95},
        "scoring_weights": {"learning_value": 0.5, "quality": 0.3, "diversity": 0.2},
    },
    "llama_3_2_instruct_optimized": {
        "quality_filters": {
            "min_turns": 2,
            "max_turns": 12,
            "min_tokens_per_turn": 15,
            "max_tokens_per_turn": 2048,
            "min_total_tokens": 100,
            "max_total_tokens": 4096,
            "must_have_roles": ["user", "assistant"],
            "check_for_refusal": True,
            "refusal_patterns": [
                "i'm sorry",
                "i cannot",
                "i am unable",
                "as an ai",
                "i can't help with that",
                "as a large language model",
                "i don't have the ability",
                "i'm not able to",
                "i cannot provide",
                "i'm not allowed",
            ],
            "balanced_conversation_ratio": 0.25,
        },
        "deduplication": {"method": "hashed", "similarity_threshold": 0.92},
        "scoring_weights": {"learning_value": 0.6, "quality": 0.3, "diversity": 0.1},
    },
    "llama_3_1_base": {
        "quality_filters": {
            "min_turns": 1,
            "max_turns": 1,
            "min_tokens_per_turn": 20,
            "max_tokens_per_turn": 3072,
            "min_total_tokens": 50,
            "max_total_tokens": 4096,
            "must_have_roles": ["user", "assistant"],
            "check_for_refusal": False,
            "balanced_conversation_ratio": 0.2,
        },
        "deduplication": {"method": "hashed", "similarity_threshold": 0.95},
        "scoring_weights": {"learning_value": 0.6, "quality": 0.3, "diversity": 0.1},
    },
}

# Method names that existing YAML files use for a neural encoder. Such an encoder is a user function
# here, so these names fall to the hashed word counts unless a vector column or an encoder is given.
ENCODER_METHODS = ("sentence_transformer", "llama_model", "faiss-gpu")


def _checked(cls, values: Mapping[str, Any], where: str):
    known = {f.name for f in fields(cls)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown keys in {where}: {', '.join(unknown)}")
    return cls(**values)


@dataclass(frozen=True)
class QualityFilters:
    min_turns: int
    max_turns: int
    min_tokens_per_turn: int
    max_tokens_per_turn: int
    min_total_tokens: int
    max_total_tokens: int
    must_have_roles: tuple[str, ...]
    balanced_conversation_ratio: float
    check_for_refusal: bool = False
    refusal_patterns: tuple[str, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "must_have_roles", tuple(self.must_have_roles))
        object.__setattr__(self, "refusal_patterns", tuple(self.refusal_patterns))


@dataclass(frozen=True)
class Deduplication:
    similarity_threshold: float
    # "hashed" counts words in ``dims`` buckets, "sparse" in a space so wide that words keep their own.
    method: str = "hashed"
    dims: int = 512
    # The text that is compared: the messages' contents, or the conversation as the template renders it.
    text: str = "content"
    # Whether rare words weigh more.
    idf: bool = True
    # Hashed vectors count n-grams of so many characters; 0: words.
    ngram: int = 0

    def __post_init__(self):
        if self.text not in ("content", "rendered"):
            raise ValueError("deduplication compares the 'content' or the 'rendered' text")
        if self.method in ENCODER_METHODS:
            warnings.warn(
                f"{self.method} is a neural encoder: unless a run has a vector column or an encoder, hashed "
                "word counts take its place, for which its threshold was not made",
                stacklevel=2,
            )
            object.__setattr__(self, "method", "hashed")
        if self.method not in ("hashed", "sparse", "column", "udf"):
            raise ValueError(f"unknown deduplication method: {self.method}")
        if self.ngram < 0 or (self.ngram and self.method != "hashed"):
            raise ValueError("ngram is 0 or the length of the n-grams of method 'hashed'")
        if not 0.0 < self.similarity_threshold <= 1.0:
            raise ValueError("similarity_threshold must be in (0, 1]")


@dataclass(frozen=True)
class ScoringWeights:
    learning_value: float
    quality: float
    diversity: float


@dataclass(frozen=True)
class Selection:
    """Limits on what may be selected; none by default.

    ``min_perplexity_score`` and ``max_perplexity_score`` bound the learning value, ends included.
    ``max_similar_samples`` bounds the rows of a cluster of similar rows.
    """

    min_perplexity_score: float | None = None
    max_perplexity_score: float | None = None
    max_similar_samples: int | None = None

    def __post_init__(self):
        if self.max_similar_samples is not None and self.max_similar_samples < 1:
            raise ValueError("max_similar_samples must be at least 1")

    @property
    def band(self) -> tuple[float, float] | None:
        if self.min_perplexity_score is None and self.max_perplexity_score is None:
            return None
        low, high = self.min_perplexity_score, self.max_perplexity_score
        return (float("-inf") if low is None else low, float("inf") if high is None else high)


@dataclass(frozen=True)
class CurationConfig:
    name: str
    quality_filters: QualityFilters
    deduplication: Deduplication
    scoring_weights: ScoringWeights
    selection: Selection = Selection()

    @classmethod
    def from_mapping(cls, name: str, raw: Mapping[str, Any]) -> CurationConfig:
        """Read the sections a run uses; batch sizes and model names have no meaning on Spark.

        ``selection`` holds limits that take effect. An ``advanced`` section is not used, and says so.
        """
        missing = [k for k in ("quality_filters", "deduplication", "scoring_weights") if k not in raw]
        if missing:
            raise ValueError(f"config {name} lacks: {', '.join(missing)}")
        if raw.get("advanced"):
            warnings.warn(
                f"the advanced section of {name} has no effect; its limits take effect in a section named selection",
                stacklevel=2,
            )
        dedup = {k: v for k, v in raw["deduplication"].items() if k != "embedding_model"}
        return cls(
            name,
            _checked(QualityFilters, raw["quality_filters"], "quality_filters"),
            _checked(Deduplication, dedup, "deduplication"),
            _checked(ScoringWeights, raw["scoring_weights"], "scoring_weights"),
            _checked(Selection, raw.get("selection") or {}, "selection"),
        )

    def with_filters(self, **changes: Any) -> CurationConfig:
        return replace(self, quality_filters=replace(self.quality_filters, **changes))

    def with_selection(self, **changes: Any) -> CurationConfig:
        return replace(self, selection=replace(self.selection, **changes))

    def with_dedup(self, **changes: Any) -> CurationConfig:
        return replace(self, deduplication=replace(self.deduplication, **changes))


def load_config(name: str) -> CurationConfig:
    """A preset by name, or a YAML file by path."""
    if name in PRESETS:
        return CurationConfig.from_mapping(name, PRESETS[name])
    if not name.endswith((".yaml", ".yml")):
        raise FileNotFoundError(f"no preset named {name}; presets are {', '.join(PRESETS)}")
    import yaml

    with open(name, encoding="utf-8") as handle:
        return CurationConfig.from_mapping(name, yaml.safe_load(handle))
