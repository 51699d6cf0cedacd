"""Patterns, phrases, names and limits that results depend on.

Everything in this module is a fixed value of the cleaning contract, kept as plain text in natural order.
Patterns are written once; `java()` adds the flags that make Spark's regex engine agree with Python's.
"""

from __future__ import annotations

import re

# advertising lines, in the order in which signals are reported
ADS = [
    r"扫码.{0,20}(?:关注|领取|添加|下载|购买|报名)",
    r"(?:关注|添加).{0,12}(?:公众号|微信|客服|老师|助教)",
    r"(?:免费|限时).{0,20}(?:领取|课程|资料|优惠|下载)",
    r"(?:购买|报名|咨询).{0,15}(?:课程|网课|客服|老师|助教)",
    r"(?:微信号|客服微信|老师微信|助教微信)\s*[:：]",
    r"(?:加群|入群|进群).{0,15}(?:学习|领取|资料|交流)?",
    r"(?:淘宝|拼多多|闲鱼|抖音|快手|小红书).{0,20}(?:购买|店铺|搜索|关注)",
]
# the signs that those phrases, units and standard ids can start with (letters in either case)
AD_SIGN = "[扫关添免限购报咨微客老助加入进淘拼闲抖快小]"
UNIT_SIGNS = "°℃KkMmPpGgCcNnLlWwVvAaHhDdSsμµ\u212a\u017f"
STANDARD_SIGNS = "GgAaHhJjSsDdNn\u017f"
HEADING = r"(?m)^#{1,6}[ \t]+\S+"
QUESTION = r"(?m)^[ \t]*(?:第[ \t]*\d+[ \t]*题|[0-9]{1,4}[.、．][ \t]*\S)"
NUMBER = r"(?<![A-Za-z0-9_])\d+(?:\.\d+)?%?(?![A-Za-z0-9_])"
PROTECTED_NUMBER = r"(?<![A-Za-z0-9_])[+-]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?%?(?![A-Za-z0-9_])"
UNIT = (
    r"(?<![A-Za-z])(?:°C|℃|°F|K|MPa|kPa|Pa|GPa|mg/m[³3]|g/m[³3]|kg/m[³3]|m/s|km/h|m[²2]|m[³3]|mm|cm|km|m|"
    r"μm|µm|nm|μg|µg|mg|kg|g|mL|L|kW|MW|W|kV|mV|V|mA|A|Hz|dB|min|ms|s|h)(?![A-Za-z])"
)
STANDARD_ID = (
    r"(?<![A-Za-z0-9])(?:GB|GB/T|AQ|AQ/T|HG|HG/T|JB|JB/T|SY|SY/T|DL|DL/T|NB|NB/T|SH|SH/T)"
    r"\s*\d+(?:\.\d+)*(?:-\d{2,4})?(?![A-Za-z0-9])"
)
URL = r"https?://[^\s<>()\[\]\"']+"
TABLE_RULE = r"(?m)^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$"
FRONT_MATTER = r"\A---[ \t]*(?:\r\n|\n|\r).*?(?:\r\n|\n|\r)---[ \t]*(?:(?:\r\n|\n|\r)|\Z)"
REPLY_FRONT_MATTER = r"\A---[ \t]*\r?\n(.*?)\r?\n---[ \t]*(?:\r?\n|\Z)"
REPLY_OPENS_FRONT_MATTER = r"^---(?:[ \t]*\r?\n|[ \t]*$)"
RULE_LINE = r"(?m)^---[ \t]*$"
HTML_DOCUMENT = r"(?is)^\s*(?:<!doctype\s+html[^>]*>\s*)?<html(?:\s|>)"
HTML_ERROR = r"(?is)<(?:title|h1)[^>]*>[^<]*(?:error|错误|bad gateway|service unavailable|forbidden)"
JSON_OBJECT = r"(?s)^\s*\{.*\}\s*$"
CJK = "[\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\u3040-\u30ff\uac00-\ud7af]"
BATCH_ID = r"^[0-9]{8}T[0-9]{12}Z-[0-9a-f]{12}$"
YEAR = r"\d{4}(?:\s*[-–—/]\s*\d{4})?"
URL_TAIL = ".,;:，。；：)]}）】》」』"

# lines of Markdown: ends, fences, list items, quotes, headings, table rules, front matter; ends of sentences
LINE_END = r"(?:\r\n|\n|\r)\Z"
LINE_BREAK = r"\r\n|\n|\r"
FENCE = r" {0,3}(`{3,}|~{3,})"
LIST_ITEM = r"([ \t]*)(?:[-+*]|\d{1,9}[.)])(?=[ \t])"
QUOTE = r" {0,3}>[ \t]?"
ATX_HEADING = r" {0,3}#{1,6}(?:[ \t]|\Z)"
TABLE_LINE = r"[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*"
FRONT_MATTER_LINE = "\ufeff?---[ \t]*"
SENTENCE_END = r"[。！？；.!?;][ \t]*"
BLANK_LINE_END = r"[ \t]*(?:\r\n|\n|\r)"

JSON_KEYS = ['"error"', '"message"', '"content"', '"choices"', '"response"', '"output"']
EXPLANATIONS = [
    "以下是清洗后的内容", "以下是清洗后的 Markdown", "以下是处理后的内容", "以下是整理后的内容", "以下是转换后的内容",
    "这是清洗后的内容", "这是处理后的结果", "根据您的要求", "根据你的要求", "我已经完成", "我已完成", "已为您清洗",
    "已为你清洗", "当然可以", "好的，", "好的。",
]
SUSPICIOUS = ["以下是处理结果", "以下为处理结果", "处理结果如下", "清洗说明：", "修改说明：", "处理说明："]
SERVICE_ERRORS = [
    "bad gateway", "service unavailable", "gateway timeout", "internal server error", "access denied", "request failed",
    "rate limit exceeded", "unauthorized", "invalid api key", "上游服务错误", "服务暂时不可用", "请求失败", "请求超时",
    "鉴权失败", "无效的 api key",
]
# patterns of secrets and what stays of them
SECRETS = [
    (r"(?i)(Bearer\s+)[^\s'\"\\]{8,}", "$1***"),
    (r"(?i)(api[_-]?key\s*[:=]\s*)[^\s'\"\\,]{8,}", "$1***"),
    (r"(?i)(Authorization\s*[:=]\s*)[^\s'\"\\,]{8,}", "$1***"),
    (r"sk-[A-Za-z0-9_-]{8,}", "***"),
    (r"key-[A-Za-z0-9_-]{8,}", "***"),
]
REQUIRED_FIELDS = ["title", "subject", "source", "type", "year", "status"]
SUBJECTS = ["安全生产法律法规", "安全生产管理", "安全生产技术基础", "安全生产专业实务"]
FIELD_STATUS = "OCR清洗完成"

FILE_STATUSES = ["pending", "running", "succeeded", "failed", "skipped", "interrupted"]
BATCH_STATUSES = ["running", "completed", "completed_with_failures", "incomplete", "stopped"]
SELECTION_SOURCES = ["scan", "selection_file", "resume", "retry_failed"]
SHOWN_FOLDER, SHOWN_PATH = "<项目目录>", "<路径>"
NORMALIZATION = "preserve-outer-fence-v1"
PROMPT_VERSION = 2
MAX_CHARS = 12_000
MAX_FILE_BYTES = 104_857_600
MAX_FAILURES_IN_A_ROW = 5
CODECS = ["utf-8-sig", "utf-8", "gb18030", "gbk"]

# thresholds of the quality policy, and its version
POLICY_VERSION = 2
THRESHOLDS = {
    "severe_min_retained_ratio": 0.30,
    "warning_min_retained_ratio": 0.50,
    "review_min_retained_ratio": 0.70,
    "severe_max_expansion_ratio": 2.00,
    "warning_max_expansion_ratio": 1.50,
    "heading_retained_ratio": 0.50,
    "question_retained_ratio": 0.70,
    "number_retained_ratio": 0.70,
    "table_retained_ratio": 0.50,
}

# messages of reviews, by rule
SAYS = {
    "values": "受保护正文中的数字、单位、标准编号或 URL 内容、数量或出现顺序发生变化，请检查法条编号、年份、限值、答案和链接",
    "anchors": "受保护正文的稳定锚点保留率低于 35%，疑似发生大范围替换、重写或重排",
    "kept_severe": "输出保留比例低于严重阈值 {}，疑似发生严重截断或正文被过度删除",
    "kept_warning": "输出保留比例低于警告阈值 {}，可能删除了过多正文",
    "kept_review": "输出保留比例低于复核阈值 {}，建议人工检查删除内容",
    "grown_severe": "输出扩写比例超过严重阈值 {}，模型可能生成了大量原文不存在的内容",
    "grown_warning": "输出扩写比例超过复核阈值 {}，请检查模型是否扩写或补充内容",
    "headings": "输出标题数量显著减少，请检查章节结构是否丢失",
    "questions": "输出题目数量显著减少，请检查题干、选项、答案和解析",
    "numbers": "输出数字数量显著减少，请检查年份、法条编号、题号、数值和单位",
    "tables": "输出表格数量显著减少，请检查 Markdown 表格是否丢失或损坏",
    "urls_added": "输出新增了原文不存在的 URL，模型可能添加了链接",
    "urls_removed": "受保护正文中的 URL 被删除，请检查来源链接是否丢失",
    "ads": "输出中仍存在疑似广告或引流文字",
    "blank": "输出为空",
    "html": "模型输出疑似 HTML 错误页，没有得到有效 Markdown",
    "json": "模型输出疑似 API JSON 响应，没有得到有效 Markdown",
    "service_short": "输出疑似服务错误信息：",
    "service_long": "输出开头出现疑似服务错误文字：",
    "explained": "输出开头可能包含模型附加说明：",
    "unclosed": "YAML Front Matter 未正确闭合或格式损坏",
    "missing": "没有检测到完整 YAML Front Matter",
    "later": "后续分片意外包含 YAML Front Matter，合并完整文档时可能产生重复 YAML",
    "several": "输出中检测到多个疑似 YAML Front Matter，请检查是否发生重复",
    "short": "输出长度不到输入的 50%，请检查是否发生内容截断",
    "field_missing": "YAML 缺少字段：{}",
    "field_kind": "YAML 字段 {} 必须是字符串、数字或 null，不能是列表或对象",
    "title_kind": "YAML 字段 title 必须是字符串或 null",
    "title_blank": "YAML 字段 title 不能为空字符串",
    "title_long": "YAML 字段 title 异常过长",
    "subject": "subject 不在允许范围内：{}",
    "status": "status 不符合要求，应为：OCR清洗完成",
    "year_flag": "YAML 字段 year 不能是布尔值",
    "year_number": "YAML 字段 year 疑似无效：{}",
    "year_text": "YAML 字段 year 格式需要复核：{}",
    "year_kind": "YAML 字段 year 必须是年份字符串、整数或 null",
    "text_kind": "YAML 字段 {} 必须是字符串或 null",
    "yaml_absent": "PyYAML 不可用，无法可靠解析 YAML Front Matter",
    "yaml_fails": "YAML 解析失败：",
    "yaml_empty": "YAML Front Matter 为空",
    "yaml_kind": "YAML Front Matter 必须是键值对象，不能是列表、字符串或其他类型",
    "fence": "输出仍以代码围栏开头，请检查模型是否使用了不受支持的围栏类型",
}



def java(pattern: str, ignore_case: bool = False) -> str:
    """The pattern with flags for Spark: \\d, \\s and \\w are Unicode, ^, $ and . know \\n only."""
    return ("(?diuU)" if ignore_case else "(?dU)") + pattern


def compiled(pattern: str, ignore_case: bool = False, dotall: bool = False) -> re.Pattern[str]:
    return re.compile(pattern, (re.IGNORECASE if ignore_case else 0) | (re.DOTALL if dotall else 0))
