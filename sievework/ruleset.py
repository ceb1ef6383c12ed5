"""Rules as data: lexicons and thresholds of the posting domain, with a version."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RuleSet:
    """Lexicons and thresholds that operators take. The defaults are fixed values of the posting domain."""

    version: str = "1"
    # fixed values: posting type
    anonymous_starts: tuple[str, ...] = ("某", "知名", "大型", "头部", "顶级", "互联网大厂", "上市", "一线")
    fragile_terms: tuple[str, ...] = ("工作室", "个体", "自由职业", "兼职")
    agency_titles: tuple[str, ...] = ("猎头顾问",)
    # fixed values: direction
    ai_terms: tuple[str, ...] = ("AI", "AIGC", "人工智能", "大模型", "LLM", "大语言模型", "生成式", "GPT", "智能体", "Agent", "算法", "机器学习", "深度学习", "多模态", "NLP", "计算机视觉", "CV", "知识图谱", "RAG", "向量", "推理模型", "FDE", "Forward Deployed")
    product_terms: tuple[str, ...] = ("产品经理", "产品负责人", "产品总监", "产品运营", "产品规划", "产品线", "产品专家", "产品企划", "产品设计", "产品专员", "产品助理", "产品策划", "产品需求", "PM", "产品实习", "解决方案", "FDE", "部署工程师", "售前", "技术支持")
    # fixed values: risk flags
    part_time_terms: tuple[str, ...] = ("兼职", "创业营", "带货", "招生", "代理", "日结", "私活", "外包")
    other_cities: tuple[str, ...] = ("北京", "上海", "深圳", "广州", "成都", "武汉", "西安", "南京", "苏州", "合肥", "长沙", "青岛", "厦门", "天津", "重庆", "郑州", "济南", "福州", "东莞", "宁波", "无锡")
    stale_days: int = 30
    outlier_high: float = 3.0
    outlier_low: float = 0.25
    # fixed values: the junk cascade
    protected_term: str = "fde"
    sales_title_terms: tuple[str, ...] = ("销售", "bd", "商务拓展", "客户经理", "sdr", "大客户", "渠道经理", "渠道销售", "招商", "外呼")
    sales_body_terms: tuple[str, ...] = ("提成", "业绩指标", "完成业绩", "回款", "签单", "客户资源", "销售目标", "销售任务", "佣金", "业绩考核")
    pay_terms: tuple[str, ...] = ("提成", "佣金", "业绩考核")
    tech_title_terms: tuple[str, ...] = ("开发", "研发", "算法", "测试", "工程师", "运维", "数据标注", "剪辑", "美工", "设计", "体验官", "管培", "运营合伙人", "招募", "技术支持", "工程")
    product_suffixes: tuple[str, ...] = ("产品经理", "产品运营")
    media_term: str = "新媒体"
    operations_terms: tuple[str, ...] = ("运营", "新媒体", "电商", "直播", "主播", "客服")
    company_industries: tuple[str, ...] = ("人工智能",)
    company_names: str = "人工智能|机器人|具身智能|智能体|(?<![a-z])ai(?![a-z])"
    company_title_excludes: tuple[str, ...] = ("结构", "工艺", "硬件", "电子", "维修", "拍摄", "客服", "外呼", "零售", "门店", "直播", "主播", "剪辑", "设计", "销售", "bd", "新媒体")
    role_words: tuple[str, ...] = ("产品", "pm", "运营", "增长", "策略", "内容", "数据", "助理", "专员", "项目", "营销", "解决方案")
    solution_titles: tuple[str, ...] = ("产品", "解决方案", "售前")
    solution_excludes: tuple[str, ...] = ("营销", "市场", "渠道", "品牌", "硬件", "结构", "工艺", "电子", "维修", "测试", "设计", "拍摄", "拍照", "文员", "客服", "外呼", "零售", "门店", "直播", "主播", "剪辑", "新媒体", "销售", "bd", "开发", "算法", "工程师", "运营合伙人")
    evidence_terms: tuple[str, ...] = ("ai产品", "aigc", "人工智能", "大模型", "llm", "gpt", "智能体", "agent", "大语言模型", "生成式", "多模态", "机器学习", "深度学习", "智驾", "adas", "自动驾驶", "具身智能", "机器人", "智能硬件", "数字人", "语音识别", "计算机视觉", "自然语言处理")
    bare_term: str = "(?<![a-z])ai(?![a-z])"
    incidental: str = r"(?:对|使用|会用|会|熟练使用|熟练|借助|利用|通过|配合|掌握|熟悉|了解|具备|优先)\s*ai|ai\s*(?:工具|辅助|提效|编程|助手|技能|能力辅助|剪辑|作图|绘画|配音|修图)"
    # thresholds
    fingerprint_body: int = 180
    fingerprint_place: int = 12
    least_body: int = 120
    active_days: int = 14
    duplicate_share: float = 0.2
    root_rate: float = 0.6
    city_rate: float = 0.95
    fidelity_length: float = 0.6


DEFAULT = RuleSet()
