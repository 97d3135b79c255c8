"""The digest's texts."""

from __future__ import annotations

# Heading of a digest document; the title is an argument of the document job.
DEFAULT_TITLE = "Daily Digest"

# Keyword explanations, the default one, and the labels shown when there are none.
KEYWORD_NOTES = {
    "AI Agent": "能自主规划并执行任务的 AI 系统",
    "AI Copilot": "嵌入工作流的智能助手",
    "AI Workflow": "用 AI 串联和自动化多步骤任务",
    "AI Analytics": "用 AI 辅助数据分析和洞察生成",
    "Retail Media": "平台基于交易与流量数据提供的广告能力",
    "Seller Tools": "帮助商家经营、投放和履约的平台工具",
    "Marketplace": "连接商家、用户和服务商的平台市场",
    "Conversion Funnel": "从曝光到成交的转化路径",
    "RAG": "检索增强生成，让模型基于资料回答",
    "Multimodal": "同时处理文本、图片、音频或视频的能力",
    "Product Signal": "能提示新需求或新交互方式的产品信号",
    "China Tech": "中国科技与平台经济动态",
}
KEYWORD_NOTE_DEFAULT = "值得持续积累的产品关键词"
KEYWORDS_DEFAULT = ("Marketplace", "Seller Tools", "Product Signal")

# Why an article matters, by category.
WHY_BY_CATEGORY = {
    "AI Frontier": "它可能改变用户获取信息、分析数据和执行任务的方式，进而影响平台工具的默认交互。",
    "E-commerce & Marketplace": "它直接关联商家经营效率、平台规则、流量分配或广告变现，是商家成长产品必须跟踪的外部变量。",
    "China Tech & Retail": "国内平台和云厂商的动作更接近你的业务语境，值得观察其产品化速度和落地方式。",
}
WHY_DEFAULT = "它提供了新产品、新模式或新增长路径的信号，适合作为产品经理的案例库。"

# Takeaways, each with the labels that give it, first match wins.
TAKEAWAYS = (
    (("Retail Media",), "不要只把广告当投放入口，要把它和经营诊断、商品优化、转化漏斗放在一起设计。"),
    (("AI Agent", "AI Workflow"), "商家工作台可以从“工具集合”升级为“任务型经营助手”，让系统主动拆解目标和下一步动作。"),
    (("AI Analytics",), "数据产品的价值不止在看板，而在解释异常、判断优先级，并让商家知道应该先做什么。"),
)
TAKEAWAY_DEFAULT = "从商家成长视角看，重点不是新闻本身，而是它能否降低商家的理解成本、决策成本或执行成本。"

# One-line signals, first match over the cited articles wins.
SIGNALS = (
    (("AI Agent", "AI Workflow"), "AI 正在从“回答问题”走向“执行经营流程”。"),
    (("Retail Media",), "零售媒体和商家工具正在更深地绑定增长动作。"),
    (("Seller Tools",), "平台竞争正在转向谁能更好地提升商家经营效率。"),
)
SIGNAL_DEFAULT = "今天值得关注的是：新工具如何把复杂经营问题变成可执行动作。"

# Thinking questions, first match over the cited articles wins.
QUESTIONS = (
    (("AI Analytics",), "如果为 POP 商家设计 AI 数据分析助手，它应该优先解释指标异常，还是直接推荐经营动作？"),
    (("Retail Media",), "如果商家同时面对自然流量和广告投放，平台应如何帮助他们判断增长来自哪里？"),
)
QUESTION_DEFAULT = "如果要为 POP 商家设计一个 AI 经营助手，第一阶段应优先解决“看不懂数据”还是“不会做动作”？"

# Hints under the thinking question.
HINTS = (
    "先区分商家真正缺的是信息、判断，还是可执行动作。",
    "把 AI 能力放进经营链路时，要考虑不同成熟度商家的理解成本。",
    "好的商家工具不只展示指标，还要解释变化原因和下一步优先级。",
)

# Tags by label, tags every digest has, and the number of tags kept.
TAG_BY_LABEL = {
    "AI Agent": "#AI-Agent",
    "AI Workflow": "#AI-Workflow",
    "AI Analytics": "#AI-Analytics",
    "Retail Media": "#Retail-Media",
    "Seller Tools": "#Seller-Growth",
    "Marketplace": "#Marketplace",
    "China Tech": "#China-Tech",
}
TAGS_ALWAYS = ("#Seller-Growth", "#Product-Strategy")
TAG_LIMIT = 6

# Learning cards in rotation order
# (concept, explanation, scenario, relation, english_expression).
LEARNING_CARDS = (
    (
        "RAG",
        "RAG 是 Retrieval-Augmented Generation，先检索可信资料，再让大模型基于资料回答。",
        "客服助手、经营诊断、政策问答都可以用 RAG 减少幻觉。",
        "商家成长产品可以用 RAG 把规则、工具教程和经营数据连接起来，给商家更可靠的建议。",
        "RAG grounds model answers in retrieved business context.",
    ),
    (
        "Retail Media",
        "零售媒体是平台把站内流量、用户意图和交易数据转化为广告与营销能力。",
        "商家在搜索、推荐、详情页等场景投放，并用成交数据衡量效果。",
        "商家成长产品需要帮助商家理解投放回报、流量质量和自然增长之间的关系。",
        "Retail media turns marketplace traffic into measurable advertising inventory.",
    ),
    (
        "Seller Lifecycle",
        "商家生命周期描述商家从入驻、冷启动、成长、成熟到流失预警的阶段变化。",
        "不同阶段的商家需要不同任务、工具、激励和经营诊断。",
        "京东 POP 商家成长可以围绕生命周期设计分层成长路径，而不是给所有商家同一套工具。",
        "Seller lifecycle design matches growth interventions to merchant maturity.",
    ),
    (
        "Conversion Funnel",
        "转化漏斗把用户从曝光、点击、加购到成交的过程拆成可诊断环节。",
        "商家可以定位是流量不足、点击率低、详情页弱，还是价格和履约影响成交。",
        "商家成长产品应把指标解释成动作建议，帮助商家知道下一步该优化什么。",
        "A conversion funnel turns business outcomes into diagnosable steps.",
    ),
)

# Document headings and texts.
HEADING_SIGNAL = "## 0. Today's One-Line Signal"
HEADING_MUST_READ = "## 1. Must Read — 今天最重要的 3 条"
HEADING_AI_WATCH = "## 2. AI Product Watch — AI 产品观察"
HEADING_MARKETPLACE = "## 3. Marketplace & Seller Growth — 商家成长相关信号"
HEADING_THINKING = "## 4. PM Thinking — 今天的产品经理思考题"
HEADING_CARD = "## 5. 5-Minute Learning Card — 今日学习卡片"
HEADING_READING = "## 6. 原文阅读清单"
HEADING_TAGS = "## 7. 今日归档标签"
HINTS_LEAD = "思考提示："
READING_HEAD = "| 标题 | 来源 | 发布时间 | 推荐阅读理由 | 链接 |"
READING_RULE = "| --- | --- | --- | --- | --- |"
EMPTY_MUST_READ = "今天没有筛出足够高质量的 Must Read。宁可少写，也不强行凑数。"
EMPTY_AI_WATCH = "今天没有筛出足够明确的 AI 产品动态。"
EMPTY_MARKETPLACE = "今天没有筛出足够明确的商家成长信号。"
DATE_UNKNOWN = "发布时间未明确"
WATCH_PROBLEM = "**它解决了什么用户问题：** 帮用户把复杂信息处理、任务执行或数据判断变得更自动、更低门槛。"
WATCH_DESIGN = "**交互或产品设计上值得学习：** 关注它是否把 AI 放进具体工作流，而不是停留在聊天入口。"
WATCH_CHANCE = "**迁移到商家成长的机会：** 可思考是否能变成商家经营诊断、投放建议、客服辅助或自动化任务编排。"
MARKET_AUDIENCE = "**影响的对象：** 商家 / 平台 / 服务商"
LABEL_WHAT = "**发生了什么：** "
LABEL_WHY = "**为什么重要：** "
LABEL_TAKEAWAY = "**对我的启发：** "
LABEL_KEYWORDS = "**可以积累的关键词：** "
LABEL_LINK = "**原文链接：** "
LABEL_SOURCE = "**来源 / 发布时间：** "
LABEL_PRIORITY = "**推荐阅读优先级：** "
LABEL_NEW = "**新能力是什么：** "
LABEL_EVENT = "**事件概要：** "
LABEL_STAGE = "**可能影响的经营环节：** "
LABEL_LESSON = "**对京东 POP 商家成长的可借鉴点：** "
LABEL_CONCEPT = "**今日概念：** "
LABEL_EXPLAIN = "**通俗解释：** "
LABEL_SCENARIO = "**典型场景：** "
LABEL_RELATION = "**和商家成长产品的关系：** "
LABEL_ENGLISH = "**英文表达：** "

# Summary cut.
SUMMARY_CHARS = 220
SUMMARY_MARK = "..."
