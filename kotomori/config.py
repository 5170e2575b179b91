"""Settings, policies and the fixed values that decide results."""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# Fixed values. They decide results, so they are listed as they are.
# --------------------------------------------------------------------------

# Class names; the position is the class id.
LABELS = ("abusive_content", "negative_sentiment", "quality_risk")

# Look-alike characters (Cyrillic lower, Cyrillic upper, Greek, digits, signs)
# and, position by position, what they stand for.
LOOKALIKE_FROM = "аеорсх" "АВЕКМНОРСТХ" "οαε" "01345" "@$!"
LOOKALIKE_TO = "aeopcx" "ABEKMHOPCTX" "oae" "oleas" "asi"

# Particles and auxiliaries dropped after tokenising.
STOPWORDS = tuple(
    "は が を に で と も の な へ から まで より て し た だ です ます ある いる する "
    "なる れる られる せる ない ぬ ず か や ね よ わ さ こ そ あ どこ これ それ あれ "
    "この その".split()
)

# Abuse lexicon: regular expressions, reported by their own text.
LEXICON = (
    "死[ね亡]",
    "殺[すし]",
    "馬鹿|バカ|ばか",
    "クズ|くず",
    "きもい|キモい|気持ち悪い",
    "うざい|ウザい",
)

# Severity tiers, first match wins: (tier, class, least risk, least confidence,
# greatest confidence); None leaves that side open. Both bounds are inclusive.
TIER_RULES = (
    ("CRITICAL", "abusive_content", 0.4, 0.7, None),
    ("HIGH", "abusive_content", 0.0, 0.75, None),
    ("MEDIUM", "negative_sentiment", None, 0.7, None),
    ("MEDIUM", "abusive_content", None, None, 0.75),
    ("LOW", "quality_risk", None, None, None),
)

# Review queue order with action and service target in minutes.
TIER_ACTIONS = (
    ("CRITICAL", "Immediate human review + auto-flag for removal", 15),
    ("HIGH", "Human review within SLA", 60),
    ("MEDIUM", "Queue for batch human review", 240),
    ("LOW", "Automated handling or scheduled review", 1440),
)

# Tier of a class when nothing more is known.
DEFAULT_TIER = ("HIGH", "MEDIUM", "LOW")

# Harm taxonomy: (class, subcategory id, name, escalate, example phrases).
TAXONOMY = (
    ("abusive_content", "direct_harassment", "Direct Harassment", True, ("死ね", "消えろ", "クズ野郎")),
    ("abusive_content", "hate_speech", "Hate Speech", True, ("差別的発言", "民族攻撃")),
    ("abusive_content", "threats", "Threats", True, ("殺すぞ", "覚えておけ")),
    ("abusive_content", "severe_insults", "Severe Insults", False, ("バカ", "アホ", "キモい")),
    ("negative_sentiment", "product_complaint", "Product / Service Complaint", False, ("最悪のサービス", "二度と使わない")),
    ("negative_sentiment", "frustration", "General Frustration", False, ("うざい", "最悪", "ありえない")),
    ("negative_sentiment", "sarcasm", "Sarcasm / Irony", False, ("すごいですね（皮肉）",)),
    ("quality_risk", "misinformation", "Potential Misinformation", False, ("フェイクニュース", "デマ")),
    ("quality_risk", "spam", "Spam / Promotional Abuse", False, ("広告スパム", "同じ内容の繰り返し")),
    ("quality_risk", "off_topic", "Off-Topic Content", False, ("関係ない話",)),
)

# Accuracy weight of a true class: missing abuse costs most.
SEVERITY_WEIGHTS = (3.0, 2.0, 1.0)

# --------------------------------------------------------------------------
# Settings
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskWeights:
    """What each evasion signal adds to the risk score (capped at ``cap``)."""

    fullwidth: float = 0.2
    homoglyphs: float = 0.3
    symbol_insertion: float = 0.25
    elongation: float = 0.1
    cyrillic: float = 0.3
    lexicon_hit: float = 0.3
    lexicon_hits_counted: int = 2
    cap: float = 1.0
    high: float = 0.4  # risk above this is "high"


@dataclass(frozen=True)
class CleanSettings:
    """Text cleaning: ``tokenizer`` is ``"char"`` or ``"script"``."""

    tokenizer: str = "char"
    remove_stops: bool = True
    stopwords: tuple[str, ...] = STOPWORDS
    # "clean_first" analyses evasion on the cleaned text, "raw_first" on the raw one
    order: str = "clean_first"


@dataclass(frozen=True)
class FeatureSettings:
    """TF-IDF vocabulary limits of the word and the character block."""

    word_ngrams: tuple[int, int] = (1, 2)
    char_ngrams: tuple[int, int] = (2, 4)
    max_word_terms: int = 50_000
    max_char_terms: int = 25_000
    min_df: int = 2
    max_df: float = 0.95


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 200
    max_depth: int = 30  # the deepest tree Spark ML grows
    min_instances: int = 2
    seed: int = 42
    # Features kept by an ANOVA F selection before the forest; None keeps all.
    select_top: int | None = None
    # Trees sample within partitions, so a fixed number makes fits repeatable whatever
    # the cluster; raise it with the number of labelled rows.
    partitions: int = 32


@dataclass(frozen=True)
class EscalationRules:
    """Thresholds of the automatic escalate / approve rules (strict)."""

    risk_above: float = 0.6
    lexicon_confidence_above: float = 0.8
    approve_confidence_above: float = 0.9
    approve_risk_below: float = 0.1


# The automatic rules as policy documents write them.
AUTO_CONDITIONS = (
    (
        "auto_escalate_to_critical",
        (
            "had_homoglyphs AND predicted_class == abusive_content",
            "adversarial_risk_score > 0.6",
            "abuse_patterns_found AND confidence > 0.8",
        ),
    ),
    ("auto_approve", ("predicted_class == quality_risk AND confidence > 0.9 AND adversarial_risk_score < 0.1",)),
)

RISK = RiskWeights()
CLEAN = CleanSettings()
FEATURES = FeatureSettings()
FOREST = ForestSettings()
ESCALATION = EscalationRules()
