"""Vocabularies and patterns. All of this module are fixed values: word lists and patterns that decide results."""

from __future__ import annotations


def any_of(*words: str) -> str:
    return "(?:" + "|".join(words) + ")"


UNI = "(?dU)"  # Unicode classes, only \n ends a line
UNI_I = "(?diU)"
LOWER = "(?dU)"  # for texts in lower case

# --- Seed pages: Chinese wrappers ---
TAIL_CONTEXT = UNI + any_of("二维码", "扫码", "扫一扫", "公众号", "朋友圈", "转发", "在看", "点赞", "客服", "添加微信", "福利", "回复关键词", "点击阅读", "阅读原文", "相关阅读", "相关推荐", "往期", "推荐", "赞赏", "投稿", "联系方式")
TAIL_MARKERS = ["全文到此为止", "点击阅读原文", "阅读原文", "长按二维码", "扫码关注", "扫描二维码", "关注公众号", "点亮在看", "转发到朋友圈", "相关阅读", "相关推荐", "往期推荐", "客服微信", "添加微信", "回复关键词", "相关链接", "往期精选", "更多阅读", "点个在看", "— END —"]
TAIL_MARKER_EXCEPTION = "阅读原文[献档]"
TAIL_PATTERNS = [
    (any_of("扫.{0,8}二维码", "二维码.{0,8}关注", "微信.{0,8}关注", "关注.{0,8}公众号"), "二维码/关注"),
    (any_of("点.{0,4}在看", "在看.{0,6}转发", "转发.{0,8}朋友圈"), "在看/转发"),
    (r"\A(?:文末)?福利(?:推荐)?\z", "福利"),
]
TAIL_STRONG = ["全文到此为止", "— END —", "福利"]
HEAD_NOISE = UNI + any_of(
    "点击上方.{0,8}(?:蓝字|蓝色字)?.{0,8}关注", "扫码关注|长按二维码|扫描二维码", r"^回复[【\[].{1,20}[】\]]", "^回复关键词",
    r"^备注[【\[].{1,20}[】\]].{0,12}(?:群|资料)", r"^(?:首页|登录|注册|导航|菜单|快速链接|上一页|下一页)(?:\s*[>|｜|/].*)?$", "点击[“\"']?接受[”\"']?加好友",
)
LINK_LINE = UNI + any_of(r"https?://", r"www\.", "上一篇", "下一篇", "相关阅读", "点击文字即可阅读", "^[-*•▶←]")
NAV_LINE = r"\A(?:首页|登录|注册|导航|菜单|快速链接|更多|返回|查看详情)\z"
OCR_PUNCT = UNI + r"[。，、；]{2,}|[。，、；]\s+[。，、；]|[。，、；]。"
# --- Numeric ranges ---
DATE_LIKE = r"\d{4}[-/年\.]\d{1,2}[-/月\.]\d{1,2}日?|\d{4}年\d{1,2}月\d{1,2}日?|\d{1,2}月\d{1,2}日"
NUMBER_RANGE = r"(?<!\d)(\d{1,6}(?:\.\d+)?)\s*(?:~|～|—|–|-|至|到)\s*(\d{1,6}(?:\.\d+)?)(?!\d)"
STANDARD_CODES = ["GB", "ISO", "ASTM", "DIN", "EN", "JIS", "HG", "QB", "JB", "YS", "DL", "SL", "SY", "YY", "JT", "NY", "MT"]
TIME_RANGE = r"\d{1,2}:\d{2}\s*[-–—~]\s*\d{1,2}:\d{2}|\d{1,2}\.\d{1,2}\s*[-–—~]\s*\d{1,2}\.\d{1,2}|\d{4}[./-]\d{1,2}[./-]\d{1,2}\s*[-–—~]\s*\d{4}[./-]\d{1,2}[./-]\d{1,2}"
# --- English seed labels: for texts in lower case, but the tail ---
EN_WRAPPER = LOWER + r"\b" + any_of("subscribe", "newsletter", "read more", "related posts?", "advertisement", "sponsored", "comments?", "share", "tweet", "follow us", "contact us", "privacy policy", "terms of use") + r"\b"
EN_WRAPPER_LINE = LOWER + r"\A" + any_of("subscribe", "newsletter", "read more", "related posts?", "advertisement", "sponsored", "comments?", "share", "follow us") + r"\z"
EN_ACCOUNT = LOWER + r"\b" + any_of("get access", "lost your password", "please enter your email address", "create a new password", "sign in", "log in", "register", "my account") + r"\b"
EN_URL = LOWER + any_of("https?://", r"www\.")
HTML = LOWER + r"<(?:/?(?:p|div|br|h[1-6]|a|script|style))\b|&(?:[a-z][a-z0-9]+|#\d+|#x[0-9a-f]+);"
ENCODING = r"\x{fffd}|\x{9225}|\x{e2}[\x{80}-\x{9f}\x{20ac}]|\x{c3}[\x{80}-\x{bf}]|\x{c2}[\x{80}-\x{bf}]"
EN_MOJIBAKE = r"[\x{5e90}\x{6845}\x{8133}\x{87fa}-\x{87ff}\x{9220}-\x{923f}\x{9500}-\x{953f}]"
NON_LATIN = r"[\x{0400}-\x{04ff}\x{0590}-\x{05ff}\x{0600}-\x{06ff}\x{3040}-\x{30ff}\x{3400}-\x{9fff}]"
EN_FORUM = LOWER + r"\b" + any_of("username", "user name", "posted by", "join date", "member since", "reply", "quote", "looking for advice", "what do you think", "anyone else", "help me choose", "to no avail", "head canons?", "i searched all over") + r"\b"
EN_PERSONAL = LOWER + r"\b" + any_of(r"hi,?\s+i(?:'| a)m", "my qualifications", "my experience", "i have a passion", "as an educator with over", "my grandfather") + r"\b"
EN_PROMO = LOWER + r"\b" + any_of("buy now", "order now", "coupon", "promo code", "affiliate", "discount", "sale price", "limited time", "free shipping", "shipping and handling", "pricing program", "ships free", "check out", "shop now", "price:", r"from \$", "free download", "download .* for mac", "safety suite", "latest malware", "sales consultant") + r"\b"
EN_PROMO_SINGLE = LOWER + any_of("roundup of the best", "best [a-z ]+ of the year", "back to school season", "it(?:'| i)s that time of the year again", r"search engine optimization \(seo\)", "we have dedicated")
EN_SOFT_PROMO = LOWER + r"\b" + any_of("roundup of the best", "best [a-z ]+ of the year", "memorial tree planted", "when you choose to have", "your wardrobe", "showcase team spirit", "back to school season", "your organization", "your business", "our bulletin", "our program", "our team", "we have dedicated", "we offer", "please note: this article is a starting point", "in no way do i believe") + r"\b"
EN_SERVICE_DOMAIN = LOWER + r"\b" + any_of("roofing", "electrician", "electrical systems?", "plumbing", "hvac", "home improvement", "contractor", "repair services?", "installation services?", "information technology", "it infrastructure", "managed it") + r"\b"
EN_SERVICE_WORDS = LOWER + r"\b" + any_of("reliable", "skilled", "professional", "experienced", "licensed", "insured", "services?", "customers?", "contact", "call", "quote", "whether you need", "your home", "your roof", "our team", "we can", "we offer", "customer satisfaction") + r"\b"
EN_BIBLIOGRAPHIC = LOWER + r"\b" + any_of("list of publications on a keyword", "book chapter or conference paper title", r"publication \(\s*name of journal\s*\)", "proceedings of", "additional document info") + r"\b"
EN_COURSE = LOWER + r"\b" + any_of("introducing [a-z]+ letters", "identify the words and sentences", "identify grammars", "lesson planner", "quick checks", "post-level assessment") + r"\b"
EN_TAIL = UNI_I + r"(?:\b(?:a|an|and|as|at|be|by|for|from|in|is|it|of|on|or|the|to|was|were|with)\b|[A-Za-z]{1,3})$"
EN_SENTENCE_END = "(?d)[.!?][\"')\\]]?$"
EN_RANGE = UNI + r"(?<!\d)(\d+(?:\.\d+)?)\s*(?:-|–|—|~|to)\s*(\d+(?:\.\d+)?)(?!\d)"
# --- Question-answer pairs ---
QA_NOISE = UNI + any_of("扫码", "公众号", "客服", "福利", "转发", "朋友圈", "点个在看", "在看功能", "在看哦", "私信", "加群", "推荐阅读", "阅读原文", "打赏", "赞赏", "恶意举报", "红友", "月儿", "新平台维护", "(?:添加|加).*微信", "微信号", "微信公众号")
QA_INFERENTIAL = any_of("为什么", "为何", "原因", "目的", "作用", "意义", "体现", "表明", "说明", "如果", "会怎样", "区别", "差异", "比较", "关系如何", "是否正确", "对不对", "能否", "可否", "主要用于", "用于什么", "功能")
QA_EXTERNAL = any_of("化用", "典故", "庄子", "此前(?:未|没有|从未)?", "首次", "第一次", "打破规则", "行业惯例", "历史主动权", "革命理想", "深远意义", "构造函数", "运行时", "高频脉冲", "反馈信号", "过程变量", "工业应用场景", "自动调节", "突破惯性思维", "高阶创新", "价值判断", "外部知识", "自律", "清白", "生活态度", "对抗虚无", "生命意义", "根腐病", "无需额外润滑", "较低吸入压力", "稳定工作", "五倍高", r"1\.5倍", "1倍。5倍", "经营", "业务类型", "可转让项目")
QA_RISKY_TAIL = any_of("用于", "便于", "提高", "实现", "推动", "体现", "展现", "说明", "意味着", "因此", "从而", "导致", "适用于", "突破", "高阶", "深刻", "历史", "革命", "自动", "控制", "调节", "机制", "原理")
QA_PRONOUN = r"\A(?:前者|后者|上述)(?:内容|说法|做法|情况|观点)?"
QA_TEST_REFERENCE = UNI + r"\A(?:上述|该|这道|这一?道?|下列)?(?:题目|试题|问题)\s*\d*\s*(?:中|里|里面|中的|所|问的是|要求的是|考查的是)|\A第\s*\d+\s*题(?:中|里|里面|中的|所)"
QA_REASONING = UNI + any_of("根据(?:生物学|物理|化学|数学)?常识", "结合(?:上下文|语境|常识)推断", "若严格(?:依|按|根据)", "严格依原文", "依据原文文字", "此处依据", "原文表述存在矛盾", "表述存在矛盾", "OCR错误", "原文OCR", "OCR质量", "若视为事实", "若视为.{0,6}则", "考题意图", "考虑到题目要求", "结合(?:常见)?考题(?:逻辑)?", "但通常", "通常指", "通常降低", "个人认为", "我认为(?:应|是)?", "让我们(?:看|来|选择|分析)")
QA_SOURCE_NOISE = UNI + any_of("热心网友", "【.{0,8}回复】", "回复结束", "试题分析", "点评[:：]", "解析[:：].{0,4}考查")
QA_DISCOURSE = UNI + any_of("让我们?换", "让我重新", "我们换一?(?:个|道)", "换一?(?:个|道)(?:更|新的|清晰|别的)", "让我们(?:选择|看|改用|换用)(?:另一|更|一个|别的|其他)", "让我们看另一", "选择更(?:稳妥|简单|清晰)的(?:事实|判断|选择)?题", "重新(?:出|设计|想)(?:一?道|一?个|个)", "我需要重新", "(?:该|这|这道|这个|此)(?:判断题|选择题|题目?)(?:的)?(?:预设)?前提不成立", "前提不成立", "无法(?:构成|设计|出)(?:一?道|一?个|有效的?)", "这(?:道|个)题(?:目)?(?:无法|不能|不成立)", "让我(?:先)?(?:想一?想|思考|分析一下这)", "作为(?:出题人|命题人|一名出题|一个出题)", "我(?:来|将|会)(?:出|设计|换)(?:一?道|一?个)(?:题|判断|选择)", "重新检查(?:文档|原文|一下)", "重新审视", "此处(?:应)?修正", "应改为(?:问|直接|具体)", "应改成(?:问|直接)", "问.{0,8}是不?合适的", "需要修正", "（注：[^）]*(?:修正|不合适|误读|重新检查)")
QA_META = UNI + any_of("(?:是否|是不是|能否|可以)?(?:属于|算作|归为|是)(?:一个|一道|一种)?(?:判断题|选择题|简答题|问答题|填空题|题型|疑问句)", "(?:这句话|该问句|这个问题|上述问题).*(?:题型|判断题|选择题|疑问句)", "(?:题型|句式)特征", "(?:属于|是哪种|哪类).*(?:视觉挑战|视觉类型|挑战类型)")
QA_CHOICE = any_of("下列(?:哪一项|哪项|哪些|哪几项|哪种|哪个)", "以下(?:哪一项|哪项|哪些|哪几项|哪种|哪个)", "哪个选项", "哪一项", "哪项", "A[.．、)]", "[（(]A[）)]")
QA_OPTION = UNI + r"(?:^|[\s\n（(])([A-DＡ-Ｄ])[.．、)）]"
QA_NOT_UNIQUE = any_of("任一", "均可", "都可", "都属于", "多个都", "不唯一")
QA_ABSENT = UNI + r"\A\s*(?:没有|未|未说明|未提供|未提到|不能确定|无法判断|正文(?:未|没有|只)|原文(?:未|没有|只)|文档(?:未|没有|只))"
QA_OPTION_BLOCK = UNI + r"\A\s*([^\nA-DＡ-Ｄ][^\n]*?)\s*\n\s*B[.．、)]\s*([^\n]+?)\s*\n\s*C[.．、)]\s*([^\n]+?)\s*\n\s*D[.．、)]\s*([^\n]+?)\s*\n+([\s\S]*)\z"
QA_VERDICT = UNI + r"正确(?:答案|选项)(?:是|为|：|:)?\s*([A-DＡ-Ｄ])[.．、)]?\s*([^。.\n，,：:]{0,20})?"
QA_LABEL = UNI + r"\A\s*(?:正确选项|选项)\s*[：:]\s*"
QA_LETTER = UNI + r"\A\s*[A-DＡ-Ｄ]\s*[.．、)]\s*"
QA_MULTI = UNI + r"\A\s*[A-DＡ-Ｄ]\s*[.．、)]\s*[A-DＡ-Ｄ][.．、)。\s]"
QA_FIRST_SENTENCE = UNI + r"\A(.{1,35}?[。.!！?？])([\s\S]+)\z"
QA_VERDICT_WORD = r"\A(?:正确|错误|真|假|是的|不是)[。.!！?？]?"
OCR_NUMBER = UNI + any_of(r"\d+(?:\.\d+)?倍[。．.]\d+(?:\.\d+)?倍(?:高|宽|大)?", r"\d+[。．.]\d+(?:MP|mL|ml|kg|g|mm|cm|米|吨|%)", r"\d+[。．.]\d+(?:倍|MP|mL|ml|kg|g|mm|cm|米|吨|%)?")
OCR_DISCLAIMER = any_of("原文(?:疑似|未|不清|有误)", "OCR", "识别")
NUMBER_UNIT = UNI + r"(?:\d+(?:\.\d+)?|[一二三四五六七八九十百千万]+)(?:倍|MP|mL|ml|kg|g|mm|cm|米|吨|%)"
SECTION_ID = UNI + r"\d+(?:\.\d+){1,3}"
# Profiles of source texts
TOC_NUMBER = UNI + r"\s\d{1,4}$"
TOC_HEAD = UNI + r"\A(?:第\s*\d+\s*[章节篇部分]|\d+(?:\.\d+)+|[一二三四五六七八九十]+[、.．)])"
ASK_VERB = "请(?:叙述|说明|分析|简述|回答|问)"
NUMBERED = r"\A[一二三四五六七八九十0-9]+[、.．)]"
EXERCISE = any_of("比一比", "组词", "组成词语", "选字填空", "形近字", "温故知新", "看拼音", "抄写")
EXERCISE_PAIR, EXERCISE_CHARS = r"[\x{4e00}-\x{9fff}]（[^）]{1,12}）", "[屡缕谱醒涛键]"
EXAM = UNI + r"第\s*\d+\s*题|简答题|填空题|选择题|计算题|问答题"
EXAM_LINE = EXAM + "|___"
EXAM_ANSWERED = any_of("答案", "解析", "参考答案", "正确答案")
CONTACT = any_of("联系人", "二维码", "扫下方", "请扫", "客服", "微信", "营业时间", "招商", "出兑", "转让", "公众号", "在看", "福利", "推广")
SYMBOLS = "[→↔↕∑×·|]"
VISUAL_TITLE = any_of("隐藏的脸", "第一眼看到了啥", "树叶还是小鸟", "香草美人", "神秘的画", "画中画", "看到了吗", "蒙娜丽莎", "梵高", "人脸")
# Rules that go by the profile
EXAM_STRUCTURAL = UNI + any_of(r"第\s*\d+\s*题.*(?:要求|涉及|问什么|考查|填空要求)", "题目(?:清单|列表)?中", "是否要求", "原文(?:未|没有|未给出)", "无法(?:判断|回答|比较)")
EXAM_TYPE = UNI + r"第\s*\d+\s*题.*题型"
CONTACT_INFERENCE = any_of("业务类型", "经营", "行业", "项目类型", "可转让项目", "为什么", "作用", "意义", "归类", "分类")
WORD_SEMANTIC = any_of("近义", "同义", "反义", "意思相近", "含义相近", "语义", "词义", "意义相同", "意义不同", "区别", "差异")
WORD_TOPIC = any_of("屡次", "一缕缕", "形近", "组词", "搭配", "词语")
READONLY = UNI_I + "readonly|只读"
RUNTIME = any_of("运行时", "动态赋值", "一旦赋值", "构造函数", "实例化", "编译时")
RUNTIME_IN_SOURCE = any_of("运行时", "动态赋值", "一旦赋值", "构造函数", "实例化")
SYMBOL_RELATION = any_of("并列关系", "共同参与", "共同构成", "支撑", "上下级", "因果", "递进", "机制", "原理", "转化", "成长", "提升", "相互作用", "逻辑关系")
SYMBOL_SIGNS = "[∑×→=+]"
SYMBOL_LITERAL = UNI + any_of("相加关系", "相乘关系", "加法", "乘法", "连接符号", "用.*连接", "由.*(?:和|与|、).*组成", "下一个", "之后", "代表", "对应", "顺序(?:是|为)", "依次为")
SYMBOL_SEMANTIC = any_of("递进", "支撑", "上下级", "因果", "机制", "原理", "逻辑", "框架", "实现", "转化", "成长", "提升", "解释", "推断")
SYMBOL_INFERENCE = any_of("关系", "原因", "作用", "为什么", "如何", "步骤", "实现", "转化", "成长", "提升", "解释", "推断", "逻辑", "框架", "递进", "支撑", "上下级", "机制")
SECTION_WORDS = any_of("节", "章", "模块", "心法", "路径", "阶段", "公式")
VISUAL_WRAPPER = any_of("文末点亮", "发给朋友", "一起看看吧", "第一眼看到了啥", "是否给出了具体答案", "给出了具体答案", "在看", "扫码", "关注备用号", "备用号", "朋友圈", "转发")
VISUAL_FRAMED = any_of("文中", "文本", "标题", "提示语", "作品名", "名字", "主题", "围绕", "列出", "出现")
VISUAL_CLAIM = any_of("实际", "确实", "真实", "需要仔细观察", "才能发现", "类似的人脸", "自画像", "视觉错觉")
VISUAL_HIDDEN = "画中隐藏|画面里隐藏"
VISUAL_HIDDEN_FRAMED = UNI + any_of("主题", "围绕", "文中.*(?:提到|列出|出现)")
VISUAL_INFERENCE = any_of("隐藏的是", "画中隐藏", "人脸", "自画像", "之一", "看到了吗", "为什么", "目的", "意义", "神奇", "巧妙", "视觉挑战")
# Rules made for one document each
CASE_SCHOOL = ("德国历史学派", UNI + "历史研究.*社会.*科学|自由.*国家权威|社会控制|公共政策", "以黑格尔为代表的哲学家")
CASE_GUESTS = ("四位嘉宾|四名嘉宾|4位嘉宾|4名嘉宾", "四个游戏", "四位嘉宾|四名嘉宾")
CASE_NATURAL = ("除了透明质酸钠", "成分(?:均|都|全部|皆)为纯天然植物萃取|均为纯天然|全部为纯天然|都为纯天然")
CASE_PUMP = ("双螺杆泵", "为什么|原因|由于|因为|从而", "无搅拌|无脉动|平稳输送", "密封液|自吸")
# --- Records ---
LABELS = {"zh": ("问题：", "答案："), "en": ("Question:", "Answer:")}
QA_MARKERS = ["Question:", "Answer:", "问题：", "答案："]
STYLE_MARKERS = ["encyclopedia style", "textbook style", "blog style", "abstract style", "_internal_style"]
STYLES = ["encyclopedia", "textbook", "blog", "abstract"]
VALID_STYLES = ["qa", "multi_style"]
MIN_LENGTH = {"qa": 500, "multi_style": 490}
MIN_LENGTH_INTERNAL = {"encyclopedia": 490, "textbook": 490, "blog": 490, "abstract": 150}
DEFAULT_MIN_LENGTH, LONG = 500, 9000
