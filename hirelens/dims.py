"""Fixed dictionaries of the job-posting domain.

FIXED VALUES: every list and mapping in this module must equal the
behaviour being reproduced (order included where a rule is
"first match wins"). They are plain data; the logic that uses them lives
in ``hirelens.functions``.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# City alias table, in match order: (full name, short name).
CITY_ALIAS: list[tuple[str, str]] = [
    ("北京市", "北京"), ("上海市", "上海"), ("广州市", "广州"), ("深圳市", "深圳"),
    ("杭州市", "杭州"), ("成都市", "成都"), ("武汉市", "武汉"),
    ("南京市", "南京"), ("西安市", "西安"), ("长沙市", "长沙"),
    ("苏州市", "苏州"), ("郑州市", "郑州"), ("天津市", "天津"),
    ("重庆市", "重庆"), ("东莞市", "东莞"), ("厦门市", "厦门"), ("佛山市", "佛山"),
    ("合肥市", "合肥"), ("无锡市", "无锡"), ("福州市", "福州"), ("青岛市", "青岛"),
    ("大连市", "大连"), ("宁波市", "宁波"), ("济南市", "济南"), ("沈阳市", "沈阳"),
    ("贵阳市", "贵阳"), ("昆明市", "昆明"), ("石家庄市", "石家庄"),
]

# Education text -> standard level, first substring match wins (in this order).
EDUCATION_MAP: list[tuple[str, str]] = [
    ("学历不限", "不限"), ("不限", "不限"),
    ("初中及以下", "不限"),
    ("中专", "大专"), ("中技", "大专"), ("高中", "大专"),
    ("大专", "大专"), ("大专及以上", "大专"),
    ("本科", "本科"), ("本科及以上", "本科"),
    ("硕士", "硕士"), ("硕士及以上", "硕士"),
    ("博士", "博士"),
]

# City -> tier; any other city is "其他".
CITY_TIER: dict[str, str] = {
    "北京": "一线", "上海": "一线", "广州": "一线", "深圳": "一线",
    "杭州": "新一线", "成都": "新一线", "武汉": "新一线",
    "南京": "新一线", "西安": "新一线", "长沙": "新一线",
}
TIER_OTHER = "其他"
TIER_DOMAIN = ["一线", "新一线", "二线", "其他"]

# City -> province for the map chart; unknown cities map to themselves.
CITY_TO_PROVINCE: dict[str, str] = {
    "北京": "北京", "上海": "上海", "天津": "天津", "重庆": "重庆",
    "深圳": "广东", "广州": "广东", "东莞": "广东", "佛山": "广东",
    "杭州": "浙江", "宁波": "浙江", "温州": "浙江",
    "南京": "江苏", "苏州": "江苏", "无锡": "江苏", "常州": "江苏",
    "成都": "四川", "绵阳": "四川",
    "武汉": "湖北", "宜昌": "湖北",
    "西安": "陕西",
    "长沙": "湖南",
    "珠海": "广东", "肇庆": "广东", "湛江": "广东",
    "郑州": "河南", "洛阳": "河南",
    "合肥": "安徽",
    "福州": "福建", "厦门": "福建",
    "青岛": "山东", "济南": "山东", "烟台": "山东",
    "大连": "辽宁", "沈阳": "辽宁",
    "昆明": "云南",
    "贵阳": "贵州",
    "石家庄": "河北",
    "哈尔滨": "黑龙江",
    "长春": "吉林",
    "太原": "山西",
    "南昌": "江西",
    "南宁": "广西",
    "海口": "海南",
    "拉萨": "西藏",
    "乌鲁木齐": "新疆",
    "呼和浩特": "内蒙古",
    "银川": "宁夏",
    "西宁": "青海",
    "兰州": "甘肃",
}

# Display names for the city map chart; other cities keep their name.
CITY_TO_GEONAME: dict[str, str] = {
    "广州": "广州市", "深圳": "深圳市", "珠海": "珠海市", "肇庆": "肇庆市",
    "东莞": "东莞市", "佛山": "佛山市", "中山": "中山市", "惠州": "惠州市",
    "江门": "江门市", "汕头": "汕头市", "湛江": "湛江市", "茂名": "茂名市",
}

# Validation domains.
VALID_CITIES: list[str] = [
    "北京", "上海", "广州", "深圳", "杭州", "成都", "武汉",
    "南京", "西安", "长沙", "苏州", "郑州", "天津", "重庆",
    "东莞", "厦门", "佛山", "合肥", "无锡", "福州", "青岛",
    "大连", "宁波", "济南", "沈阳", "贵阳", "昆明", "石家庄",
]
VALID_EDUCATION: list[str] = ["不限", "大专", "本科", "硕士", "博士"]
COMPANY_SIZES: list[str] = [
    "少于50人", "50-150人", "150-500人", "500-1000人", "1000-5000人",
    "5000-10000人", "10000人以上",
]
UNKNOWN_CITY = "未知"
UNKNOWN = "未知"
NEGOTIABLE_MARK = "面议"
NEGOTIABLE_RATIO_LIMIT = 0.3
NEGOTIABLE_FACTOR = 1.1

# Ordinal codes used as model features.
EDUCATION_ORDER: dict[str, int] = {"不限": 0, "大专": 1, "本科": 2, "硕士": 3, "博士": 4}
CITY_TIER_ORDER: dict[str, int] = {"其他": 0, "二线": 0, "新一线": 1, "一线": 2}
COMPANY_SIZE_CODE: dict[str, int] = {
    "少于50人": 1, "50-150人": 2, "150-500人": 3,
    "500-1000人": 4, "1000-5000人": 5, "5000-10000人": 6, "10000人以上": 7,
}
COMPANY_SIZE_DEFAULT = 3

# Experience bins, left-closed [lo, hi): statistics report and dashboard.
STATS_EXP_BINS: list[tuple[float, float, str]] = [
    (0, 1, "0-1年"), (1, 2, "1-2年"), (2, 3, "2-3年"), (3, 5, "3-5年"),
    (5, 7, "5-7年"), (7, 10, "7-10年"), (10, 15, "10-15年"), (15, 100, "15年+"),
]
DASH_EXP_BINS: list[tuple[float, float, str]] = [
    (0, 1, "0-1年"), (1, 3, "1-3年"), (3, 5, "3-5年"), (5, 7, "5-7年"),
    (7, 10, "7-10年"), (10, 100, "10年+"),
]
DASH_EXP_RANGES = ["0-1年", "1-3年", "3-5年", "5-7年", "7-10年"]

# Skill dictionary (membership is what matters, not order).
SKILL_DICT: list[str] = [
    "Python", "Java", "JavaScript", "TypeScript", "Go", "Golang", "Rust",
    "C++", "C", "C#", "Scala", "Kotlin", "Swift", "PHP", "Ruby", "Perl",
    "Shell", "Bash", "MATLAB", "R",
    "SQL", "MySQL", "PostgreSQL", "Oracle", "MongoDB", "Redis",
    "Elasticsearch", "ClickHouse", "HBase", "Neo4j", "TDengine", "Doris",
    "Spark", "Hadoop", "Hive", "Flink", "Kafka", "Storm", "Airflow",
    "Zookeeper", "Sqoop", "DataX", "Azkaban", "DolphinScheduler",
    "Machine Learning", "深度学习", "自然语言处理", "计算机视觉",
    "TensorFlow", "PyTorch", "Keras", "Scikit-learn", "XGBoost",
    "Pandas", "NumPy", "Scipy", "Jupyter", "MLflow", "Kubeflow",
    "ETL", "数据仓库", "数据湖", "数据建模", "数据治理",
    "Tableau", "Power BI", "FineReport", "Metabase", "Superset",
    "AWS", "Azure", "GCP", "阿里云", "腾讯云", "华为云",
    "Docker", "Kubernetes", "K8s", "Jenkins", "Git", "CI/CD",
    "Linux", "Unix",
    "Excel", "SPSS", "SAS", "VBA", "爬虫", "Scrapy", "Selenium",
    "数据分析", "数据挖掘", "数据可视化",
]

# Skill aliases: exact, case-sensitive lookup.
SKILL_ALIAS: dict[str, str] = {
    "Golang": "Go",
    "Python3": "Python", "python3": "Python", "python": "Python",
    "JS": "JavaScript", "Node.js": "JavaScript", "NodeJS": "JavaScript",
    "TypeScript": "JavaScript",
    "CPP": "C++", "C plus plus": "C++",
    "K8s": "Kubernetes", "k8s": "Kubernetes",
    "sklearn": "Scikit-learn", "scikit_learn": "Scikit-learn",
    "tf": "TensorFlow", "TF": "TensorFlow",
    "torch": "PyTorch",
    "xgboost": "XGBoost", "xgb": "XGBoost",
    "plt": "Matplotlib", "plotly": "Plotly",
    "深度学习": "Deep Learning", "Deep Learning": "Deep Learning",
    "自然语言处理": "NLP", "NLP": "NLP", "nlp": "NLP",
    "计算机视觉": "CV", "CV": "CV", "cv": "CV",
    "机器学习": "Machine Learning", "machine learning": "Machine Learning",
    "ML": "Machine Learning",
    "爬虫": "Web Scraping", "网络爬虫": "Web Scraping",
    "数据挖掘": "Data Mining", "data mining": "Data Mining",
    "数据可视化": "Data Visualization", "data visualization": "Data Visualization",
    "数仓": "数据仓库", "数据仓库": "数据仓库",
    "关系型数据库": "SQL", "RDBMS": "SQL",
    "pg": "PostgreSQL",
    "mongo": "MongoDB",
    "es": "Elasticsearch", "ES": "Elasticsearch",
    "阿里云": "Aliyun", "aliyun": "Aliyun",
    "腾讯云": "Tencent Cloud", "华为云": "Huawei Cloud",
    "docker": "Docker",
    "office": "Excel", "ms office": "Excel",
    "powerbi": "Power BI", "power bi": "Power BI",
    "ci": "CI/CD", "cd": "CI/CD",
    "git": "Git",
    "linux": "Linux",
}

# Skill regex alternatives, leftmost-first, matched case-insensitively.
# "R" must not be followed by a word character.
SKILL_REGEX_WORDS: list[str] = [
    "Python", "Java", "SQL", "Spark", "Hadoop", "Hive", "Flink", "Kafka",
    "Docker", "Kubernetes", "K8s", "TensorFlow", "PyTorch", "Scikit-learn",
    "Pandas", "NumPy", "Excel", "Tableau", "Power\\s*BI", "Linux", "Git",
    "AWS", "Azure", "GCP", "MongoDB", "Redis", "Elasticsearch", "ClickHouse",
    "Go", "C\\+\\+", "Rust", "Scala", "MATLAB", "R<END>", "Shell", "PHP",
    "Selenium", "Scrapy", "Jenkins",
    "机器学习", "深度学习", "自然语言处理", "计算机视觉", "数据分析", "数据挖掘",
]

# Keyword -> core skills added on extraction (substring of the keyword).
KEYWORD_SKILLS: list[tuple[str, list[str]]] = [
    ("Python", ["Python"]),
    ("AI", ["Python", "Machine Learning", "TensorFlow"]),
    ("算法", ["Python", "Machine Learning", "TensorFlow"]),
    ("数据分析", ["Python", "SQL", "Excel", "Pandas"]),
    ("大数据", ["Hadoop", "Spark", "SQL", "Hive"]),
]

# Tag values treated as a missing tag list.
BLANK_TAG_MARKERS = ["", "nan", "无"]

# Non-skill words removed from the word cloud and the KPI top skill.
SKILL_BLOCKLIST: list[str] = [
    "本科", "大专", "硕士", "博士", "不限", "中技", "中专", "高中", "初中及以下",
    "无需经验", "1年", "1年及以上", "2年及以上", "3年及以上", "5年及以上",
    "8年及以上", "1-3年", "2-3年", "2-5年", "3-5年", "3-4年", "5-7年", "5-10年",
    "五险一金", "六险一金", "五险", "补充医疗保险", "补充公积金", "商业保险",
    "带薪年假", "带薪病假", "年终奖金", "绩效奖金", "项目奖金", "股票期权",
    "定期体检", "定期团建", "专业培训", "培训", "餐饮补贴", "餐补", "有餐补",
    "节日福利", "员工旅游", "通讯补贴", "交通补贴", "出差补贴", "住房补贴",
    "弹性工作", "周末双休", "双休", "出国机会", "免费班车", "免费停车",
    "零食下午茶", "下午茶", "节假日", "全勤奖", "工龄奖", "管理规范",
    "计算机", "计算机科学", "编程语言", "编程", "软件工程", "软件开发",
    "后端开发", "需求分析", "自动化",
]

# Experience words meaning "no requirement".
EXP_NONE_WORDS = ["不限", "应届", "在校", "无需"]
EXP_OPEN_WORD = "以上"
EXP_OPEN_MAX = 999.0
EXP_CAP = 30

# Salary grammar constants.
WORKDAYS_PER_MONTH = 21.75
HOURS_PER_DAY = 8
SALARY_NEGOTIABLE_WORDS = ["面议", "薪资面议", "待遇面议", "open"]
BONUS_ANNUAL_THRESHOLD = 80000
OUTLIER_SALARY_MAX = 1_000_000

# Segment naming words for cluster profiles.
AI_INDUSTRY_WORDS = ["人工智能", "AI", "算法", "半导体", "芯片"]
HIGH_EDUCATION = ["硕士", "博士"]

# Response-block classification (fetched pages).
BLOCK_STATUS = [403, 429, 503, 504]
BLOCK_REDIRECT_WORDS = ["verify", "captcha"]
BLOCK_BODY_WORDS = ["验证", "captcha", "滑块", "请稍后再试", "访问频率", "ip限制"]
JSON_OK_CODES = ["0", "200"]
# "page has jobs": salary-like token pattern and the long-text rule.
SALARY_TOKEN_PATTERN = "[0-9]+[kK千]-?[0-9]*[kK万千]?"
JOB_PAGE_MARKER = "Python"
JOB_PAGE_SUGGEST = "搜索发现"
WAF_MARKERS = ["滑块", "aliyun_waf"]
# Crawl scope: target cities (substring filter).
TARGET_CITIES = ["北京", "上海", "广州", "深圳", "杭州", "成都", "武汉", "南京", "西安", "长沙"]
PAGE_SIZE = 50
# Segment names of cluster profiles, by rule (see hirelens.ml.profile).
SEGMENT_NAMES = {
    "senior_high_pay": "高薪资深岗", "very_high_pay": "超高薪技术岗", "high_edu_high_pay": "高学历高薪岗",
    "high_pay_tech": "高薪技术岗", "senior_tech": "高级技术岗", "mid_senior_tpl": "中高级{}技术岗",
    "entry_analyst": "入门分析岗", "junior_entry": "初级入门岗", "mid_tech": "中级技术岗", "junior_general": "初级通用岗",
}
# Model settings.
RF_TREES, RF_DEPTH, RF_MIN_INSTANCES, SEED = 200, 15, 2, 42
GBT_ITER, GBT_DEPTH, GBT_STEP = 200, 6, 0.1
KMEANS_K_RANGE = list(range(2, 10))
KMEANS_MAX_ITER = 300
KMEANS_STARTS = 10
SILHOUETTE_FLOOR, KMEANS_FALLBACK_K = 0.2, 4
TFIDF_MIN_DF, TFIDF_MAX_DF = 2, 0.8
SVD_DIM = 5
TRAIN_SHARE_TENTHS = 8
# ------------------------------------------------------------ END FIXED VALUES
