"""Tunable settings and fixed values shared by every job."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Weights:
    """Weight of each score component in the total."""

    impact: float = 0.30
    novelty: float = 0.25
    source_quality: float = 0.20
    pm_relevance: float = 0.15
    actionability: float = 0.10

    @staticmethod
    def from_config(values: Mapping[str, float] | None) -> "Weights":
        """Take each weight from ``values`` where present, else its default."""
        values = values or {}
        known = {f.name: float(values[f.name]) for f in fields(Weights) if f.name in values}
        return Weights(**known)


# The weight set of the usual deployment.
DEPLOYED_WEIGHTS = Weights(
    impact=0.25, novelty=0.20, source_quality=0.15, pm_relevance=0.25, actionability=0.15
)

# Categories.
AI_FRONTIER = "AI Frontier"
AI_VIDEO = "AI Product Video"
PRODUCT_SIGNALS = "Product & Startup Signals"
MARKETPLACE = "E-commerce & Marketplace"
CHINA_RETAIL = "China Tech & Retail"
CATEGORIES = (AI_FRONTIER, AI_VIDEO, PRODUCT_SIGNALS, MARKETPLACE, CHINA_RETAIL)

# Terms per score component.
SCORE_TERMS = {
    "impact": (
        "launch", "released", "announces", "platform", "marketplace", "ads", "advertising",
        "retail media", "seller", "merchant", "enterprise", "partnership", "regulation",
        "price change", "opens", "global", "growth", "增长", "平台", "商家", "广告", "零售", "电商",
    ),
    "novelty": (
        "ai", "agent", "agents", "copilot", "browser", "search", "multimodal", "workflow",
        "automation", "rag", "analytics", "model", "reasoning", "assistant", "new", "frontier",
        "智能体", "大模型", "自动化", "多模态",
    ),
    "pm_relevance": (
        "seller", "merchant", "marketplace", "e-commerce", "ecommerce", "retail", "ads",
        "advertising", "conversion", "funnel", "analytics", "dashboard", "enterprise", "business",
        "workflow", "automation", "onboarding", "customer service", "supply chain", "fulfillment",
        "growth", "商家", "电商", "经营", "转化", "流量", "投放", "客服", "履约",
    ),
    "actionability": (
        "tool", "dashboard", "workflow", "automation", "playbook", "guide", "case study",
        "best practice", "template", "api", "integrations", "诊断", "工具", "方法", "实践", "数据",
    ),
}

# Keyword labels with the terms that give them, in label order.
LABEL_TERMS = {
    "AI Agent": ("agent", "agents", "智能体"),
    "AI Copilot": ("copilot", "assistant", "助手"),
    "AI Workflow": ("workflow", "automation", "自动化"),
    "AI Analytics": ("analytics", "data analysis", "dashboard", "数据分析"),
    "Retail Media": ("retail media", "ads", "advertising", "广告"),
    "Seller Tools": ("seller", "merchant", "商家"),
    "Marketplace": ("marketplace", "平台", "电商"),
    "Conversion Funnel": ("conversion", "funnel", "转化"),
    "RAG": ("rag", "retrieval"),
    "Multimodal": ("multimodal", "多模态"),
}

# Labels that follow from the category alone.
CATEGORY_LABELS = {PRODUCT_SIGNALS: "Product Signal", CHINA_RETAIL: "China Tech"}

# Terms that raise the relevance of a frontier article.
FRONTIER_BUSINESS_TERMS = ("workflow", "analytics", "enterprise", "business", "automation")

# Words of share-price news, and the words that excuse them.
FINANCE_WORDS = ("stock", "shares", "earnings", "财报", "股价")
PRODUCT_WORDS = (
    "strategy", "launch", "product", "platform", "ads", "seller", "merchant",
    "战略", "产品", "平台", "商家",
)

# Growth stages with the terms that give them, and the stages used when none fits.
STAGE_TERMS = {
    "入驻": ("onboarding", "入驻"),
    "流量/广告": ("ads", "advertising", "retail media", "traffic", "广告", "流量"),
    "转化": ("conversion", "checkout", "转化"),
    "履约": ("fulfillment", "supply chain", "delivery", "履约", "供应链"),
    "数据分析": ("analytics", "dashboard", "data", "数据"),
}
DEFAULT_STAGES = ("选品", "流量", "转化", "数据分析")


@dataclass(frozen=True)
class Lexicon:
    """Every word list a score or a label depends on; replace any of them per run."""

    score_terms: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: SCORE_TERMS)
    label_terms: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: LABEL_TERMS)
    category_labels: Mapping[str, str] = field(default_factory=lambda: CATEGORY_LABELS)
    frontier_terms: tuple[str, ...] = FRONTIER_BUSINESS_TERMS
    finance_words: tuple[str, ...] = FINANCE_WORDS
    product_words: tuple[str, ...] = PRODUCT_WORDS
    stage_terms: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: STAGE_TERMS)
    default_stages: tuple[str, ...] = DEFAULT_STAGES


DEFAULT_LEXICON = Lexicon()

# Tracking parameters removed from links.
TRACKING_KEYS = ("fbclid", "gclid", "mc_cid", "mc_eid", "spm")
TRACKING_PREFIX = "utm_"


@dataclass(frozen=True)
class Section:
    """A digest section: best ``limit`` articles of its categories at or above ``threshold``."""

    name: str
    threshold: float
    categories: tuple[str, ...] | None
    limit: int = 3


# Digest sections in digest order.
SECTIONS = (
    Section("must_read", 3.0, None),
    Section("ai_watch", 2.8, (AI_FRONTIER, PRODUCT_SIGNALS)),
    Section("marketplace", 2.65, (MARKETPLACE, CHINA_RETAIL)),
)

# Priority bounds.
PRIORITY_HIGH = 4.2
PRIORITY_MEDIUM = 3.0


@dataclass(frozen=True)
class RunSettings:
    """Day windows, caps and rules of a digest run."""

    lookback_days: int = 3
    cache_retention_days: int = 7
    archive_min_days: int = 7
    archive_limit: int = 24
    items_per_source: int = 8
    failure_threshold: int = 3
    success_grace_days: int = 3
    include_unstable: bool = False
    weights: Weights = Weights()
    lexicon: Lexicon = DEFAULT_LEXICON
    sections: tuple[Section, ...] = SECTIONS


@dataclass(frozen=True)
class Gate:
    """Minimum counts of a run that may be published."""

    min_candidates: int = 20
    min_fresh: int = 20
    min_must_read: int = 2
    min_ai_watch: int = 2
    min_marketplace: int = 2


@dataclass(frozen=True)
class Quota:
    """Target counts of a hand-supplied candidate file."""

    min_items: int = 18
    max_items: int = 30
    min_ai: int = 8
    min_marketplace: int = 5
    min_china: int = 3


# Fixed value: how titles of stored fetch failures begin.
WARNING_MARK = "[Fetch warning]"

# Error texts of a name-resolution outage, and of any network-wide failure.
DNS_MARKERS = ("nodename nor servname provided", "temporary failure in name resolution")
NETWORK_MARKERS = (
    "nodename nor servname provided",
    "name or service not known",
    "temporary failure in name resolution",
    "could not resolve host",
    "network is unreachable",
    "curl fallback failed",
)
