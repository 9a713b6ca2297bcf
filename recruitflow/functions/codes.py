"""Fixed values of the reporting definitions.

Fixed values: every string below must equal the source definitions
exactly, because the marts emit them as labels or filter on them.
"""

# Industry group code -> label.
INDUSTRY_GROUP_LABELS = {
    "IA": "IT・インターネット・ゲーム・通信",
    "IB": "メーカー",
    "IC": "コンサルティング",
    "ID": "商社・流通・小売・サービス",
    "IE": "広告・マスコミ・エンターテインメント",
    "IF": "金融・不動産・建設",
    "IG": "医薬・医療・バイオ・メディカル",
    "IH": "インフラ・公共・その他",
}

# Job group code -> label.
JOB_GROUP_LABELS = {
    "JA": "営業",
    "JB": "IT・WEB・エンジニア",
    "JC": "マーケティング",
    "JD": "メーカー",
    "JE": "経営・企画・管理",
    "JF": "販売・サービス",
    "JG": "資材・購買・物流",
    "JH": "建設・土木",
    "JI": "コンサルタント",
    "JJ": "金融・不動産",
    "JK": "メディカル",
    "JL": "専門職",
    "JM": "クリエイティブ",
    "JN": "その他",
}

# Application route code -> label (scout routes handled apart).
ROUTE_LABELS = {
    "SPE": "公募・特集",
    "SCT": "DM",
    "HSC": "DM",
    "APL": "通常応募",
    "REC": "レコメンド応募",
}
ROUTE_SCOUT = "PSC"
ROUTE_OTHER = "Other"
SCOUT_CLASS_INTERESTED = "FL"

# Scout labels with and without the ordering prefix.
PS_LABELS_NUMBERED = ("1_興味があるPS", "2_その他PS")
PS_LABELS_PLAIN = ("興味があるPS", "その他PS")

# Acquisition channel.
CHANNEL_ORGANIC = "Organic"
CHANNEL_ORGANIC_ALIASES = ("Organic", "app")
CHANNEL_SEPARATOR = "_"

# Status and type codes.
STATUS_HS_CANDIDATE = ("ITV__", "MTADJ")
STATUS_HS_COMPANY = ("ITV__",)
STATUS_OFFER = "OFFER"
STATUS_HIRE_CANCELLED = "HIRNG"
CANDIDATE_LEFT = "LFT"
CONVERSION_INTERESTED = "FLW"
THREAD_SCOUT = "PSC"
JOB_PUBLISHED = "PUB"
SEGMENT_SCOUT_TYPE = "S"
SEGMENT_SENDING = "SND"
PRODUCT_MAIN = "MAI"
COMPANY_DIRECT = "CRS"
COMPANY_AGENT = "ESS"
NOT_DELETED = "N"
FLAG_TRUE = "TRUE"
FLAG_FALSE = "FALSE"
FIRST_DISPLAY = "1"

# JSON key holding the first-interview time (epoch ms).
INTERVIEW_SET_KEY = "firstInterviewSetTime"

# Income label unit and divisor.
INCOME_UNIT = "万円"
INCOME_DIVISOR = 10000

# Remarks of plan-change sales rows, as a regular expression.
PLAN_CHANGE_REMARKS = "ご利用プラン*"

# Sales product types.
SALES_REPLACE = "REP"
SALES_OFFSET = "OFF"
SALES_REDUCE = "RDC"
SALES_BORROW = "BOR"

# Action labels of the candidate log.
M1_ACT = {
    "register": "0_登録",
    "login": "1_ログイン",
    "interest": "2_興味がある",
    "scout": "3_PS送信",
    "apply": "4_応募",
    "hs": "5_HS",
    "offer": "6_内定",
    "decision": "7_決定",
    "left": "8_退会",
}

# Action labels of the company log.
M4_ACT = {
    "contract": "0_契約中",
    "publish": "1_求人公開",
    "auto_scout": "2_自動SCT設定",
    "login": "3_ログイン",
    "scout": "4_PS送信",
    "footprint": "5_足あと",
    "interest": "6_興味ある",
    "apply": "7_応募",
    "hs": "8_HS",
    "interview": "9_1面設定",
    "offer": "10_内定",
    "decision": "11_決定",
}

# Action labels of the company log with cohort dates.
M5_ACT = {
    "publish": "求人公開",
    "login": "ログイン",
    "interest": "興味ある",
    "scout": "PS送信",
    "reply": "PS返信",
    "apply": "応募",
    "hs": "HS",
    "interview": "1面設定",
    "offer": "内定",
    "decision": "決定",
    "sales": "SF決定",
}
