"""Patterns and word lists that results depend on, as plain text.

Regular expressions are written for Java with ``(?iuU)`` where case or word borders
matter beyond ASCII.
"""

# Text cleaning.
HTML_TAG = "<[^>]+>"
HTML_ENTITY = "&[a-z]+;|&#\\d+;"
BULLETS = "[•·▪►●◦‣▶★\\*]"

# URL decoration and listing suffixes by site.
URL_DECORATION = "[?#].*\\z"
SITE_SUFFIX = {"itviec": "-\\d+/?\\z", "vietnamworks": "--\\d+-jv/?\\z"}

# Salary units; one US dollar in VND.
USD_TO_VND = 26_000.0
SALARY = {
    "usd": "usd|\\$",
    "decimal": "tr|triệu|tỷ",
    "thousand": "nghìn|\\d+(?:[.,]\\d+)?\\s*k\\b",
    "million": "tr|triệu|m",
    "billion": "tỷ",
    "unit": "usd|\\$|nghìn|\\d+(?:[.,]\\d+)?\\s*k\\b|tr|triệu|tỷ",
    "usd_k": "\\d+(?:[.,]\\d+)?\\s*k\\b",
    "day": "ngày",
    "week": "tuần",
    "year": "năm|year",
    "upto": "tới|đến|upto|up to",
    "from": "từ|trên",
}

# Years of experience, on accent-free lower-case text.
EXPERIENCE = {
    "none": "khong yeu cau|khong yc|ko yc|khong ycau|no experience|no exp|not required|\\bfresh\\b|fresher|entry[ -]?level|moi tot nghiep|new grad",
    "less": "less than|under|below|duoi|it hon",
    "over": "over|more than|tren|tro len|\\d+\\s*\\+|\\+\\s*$",
    "month": "thang|month|occupational",
    "range": "-|\\bto\\b|den|toi",
}

# Categories by first match, on accent-free lower-case text.
EDUCATION = [
    ("cao hoc|thac si|master|tien si|doctor|prof", "Cao học"),
    ("dai hoc|bachelor|cu nhan", "Đại học"),
    ("cao dang|associate", "Cao đẳng"),
    ("trung cap|nghe|vocational", "Trung cấp / Nghề"),
    ("thpt|pho thong|cap 3|high school", "Trung học phổ thông"),
    ("co so|cap 2", "Trung học cơ sở"),
    ("khong gioi han|khong yeu cau", "Không giới hạn"),
]
POSITION = [
    ("thuc tap sinh|sinh vien|intern|internship|student", "Thực tập sinh"),
    ("moi tot nghiep|fresh graduate|fresher|\\bfresh\\b|entry[ -]?level|new grad", "Mới tốt nghiệp"),
    (
        "giam doc|pho giam doc|tong giam doc|cap cao hon|truong chi nhanh|c[- ]?level|chief|executive|\\bceo\\b|\\bcto\\b|\\bcfo\\b|\\bcoo\\b|\\bcmo\\b|\\bciso\\b|"
        "founder|co[- ]?founder|chairman|president|vice president|\\bvp\\b|director|head of",
        "Giám đốc",
    ),
    ("truong nhom|to truong|giam sat|supervisor|team lead|team leader|\\blead\\b|leader", "Trưởng nhóm"),
    ("truong phong|pho phong|truong/pho phong|truong bo phan|pho bo phan|quan ly|manager|\\bmgr\\b|head", "Trưởng phòng"),
    ("nhan vien|chuyen vien|staff|officer|employee|associate|specialist|consultant|\\bsenior\\b|\\bsr\\b|\\bjunior\\b|\\bjr\\b|\\bmid\\b", "Nhân viên"),
]
JOB_TYPE = [("part|ban thoi gian", "Bán thời gian"), ("full|toan thoi gian", "Toàn thời gian")]
NOT_STATED, OTHER_TYPE = "Không đề cập", "Khác"
UNKNOWN, VIETNAM, ABROAD, OTHERS = "Không xác định", "Việt Nam", "Nước ngoài", "Others"

# Keywords of titles, on accent-free lower-case text. The first matching level, then every flag.
TITLE_LEVELS = [
    ("intern|thuc tap sinh", "Intern"),
    ("fresher|moi ra truong", "Fresher"),
    ("\\bjunior\\b", "Junior"),
    ("\\b(middle|mid-level)\\b", "Middle"),
    ("\\b(senior|cvcc|chuyen vien cap cao|chuyen vien chinh)\\b", "Senior"),
    ("\\b(lead|manager|truong nhom|truong phong|truong bo phan|giam doc)\\b", "Manager/Lead"),
]
TITLE_FLAGS = [
    ("data|du lieu", "Data"),
    ("business|nghiep vu", "Business"),
    ("intelligence|thong minh", "Intelligence"),
    ("machine learning|\\bml\\b|hoc may", "Machine Learning"),
    ("artificial intelligence|\\bai\\b|tri tue nhan tao", "AI"),
    ("database|co so du lieu|\\bdba\\b", "Database"),
    ("analytics", "Analytics"),
    ("scientist|science|nha khoa hoc", "Scientist"),
    ("engineer|ky su", "Engineer"),
    ("analyst|phan tich", "Analyst"),
    ("administrator|quan tri", "Administrator"),
]

# What is cut out of titles, in this order, and what takes its place.
TITLE_CUTS = [
    ("\\[.*?\\]", " "),
    ("(?iuU)(-\\s*)?(up\\s*to|upto|lương|salary|thu nhập)\\s*[:\\d].*?(\\)|\\z)", ""),
    ("(?iuU)\\s*-\\s*(khối|phòng|ban|domain|k\\.cntt|hà nội|hồ chí minh|tmo|\\d+ năm|game|snop).*", ""),
    ("\\(.*?\\)|\\([^)]*\\z", ""),
    ("(?iuU)^(cv/cvcc|chuyên viên/|chuyên viên chính|cv/ cvcc)\\s*", ""),
    ("\\s*-\\s*\\z", ""),
]

# What is cut out of company names: first the pre-cleaning, then noise, legal forms, punctuation.
COMPANY_CUTS = [
    ("(?iu)https?://\\S+|www\\.\\S+", ""),
    ("\\([^)]*\\)", ""),
    ("[\\.\\(\\)\\[\\]\\-,/|_\"'’‘“”&–—]", " "),
    ("(?U)\\s+", " "),
    (
        "(?iuU)\\b(https?://[^\\s]+|member of viettel group|toàn cầu|corporation|corporate|limited|company|group|co\\.?,?\\s*ltd|ltd\\.?|jsc\\.,?|jsc|"
        "corp\\.|corp|inc\\.|inc|và|số|tm\\s*&\\s*dv|tmdv|tm\\s*dv)\\b",
        " ",
    ),
    (
        "(?iuU)\\b(ngân hàng thương mại cổ phần|ngân hàng tmcp|trách nhiệm hữu hạn|một thành viên|1 thành viên|công ty tnhh mtv|công ty tnhh|công ty cổ phần|"
        "công ty cp|tổng công ty|tổng cty|cty tnhh|cty cp|cttnhh|ctcp|công ty|cty|tập đoàn|chi nhánh|văn phòng đại diện|văn phòng|trung tâm|"
        "chuỗi nhà hàng|tnhh|mtv|cổ phần|cp)\\b",
        " ",
    ),
    ("[\\.\\(\\)\\[\\]\\-,/|]", " "),
]

# Brand rewrites of company names, in this order.
BRANDS = [
    ("VIỄN THÔNG QUÂN ĐỘI", "VIETTEL"),
    ("BƯU CHÍNH VIỄN THÔNG", "VNPT"),
    ("GIẢI PHÁP THANH TOÁN", "VNPAY"),
    ("CÔNG THƯƠNG", "VIETINBANK"),
    ("ĐẦU TƯ VÀ PHÁT TRIỂN", "BIDV"),
    ("NGOẠI THƯƠNG", "VIETCOMBANK"),
    ("SÀI GÒN THƯƠNG TÍN", "SACOMBANK"),
    ("KỸ THƯƠNG", "TECHCOMBANK"),
    ("Á CHÂU", "ACB"),
    ("QUÂN ĐỘI", "MB BANK"),
    ("SỮA VIỆT NAM", "VINAMILK"),
    ("DẦU KHÍ", "PETROVIETNAM"),
    ("DẦU VIỆT NAM", "PETROLIMEX"),
    ("ĐIỆN LỰC", "EVN"),
    ("HÀNG KHÔNG", "VIETNAM AIRLINES"),
    ("VIỆT NAM AIRLINES", "VIETNAM AIRLINES"),
]
FUZZY_SCORE, LENGTH_RATIO = 90, 0.6

# List columns of the clean layer and the requirement type each becomes.
REQUIREMENT_TYPES = [
    ("job_title_special_keywords", "special_keyword"),
    ("require_programming_languages", "programming_language"),
    ("require_frameworks", "framework"),
    ("require_tools", "tool"),
    ("require_cloud_skills", "cloud_skill"),
    ("require_knowledge", "knowledge"),
    ("require_domain_knowledge", "domain_knowledge"),
    ("require_foreign_languages", "foreign_language"),
    ("require_domain_university", "domain_university"),
]

# Weights of the re-ranking formula and of its skill groups.
RANK_WEIGHTS = {"cosine": 0.50, "skill_overlap": 0.30, "experience_match": 0.12, "location_match": 0.08}
SKILL_WEIGHTS = {
    "require_programming_languages": 0.30,
    "require_frameworks": 0.25,
    "require_tools": 0.15,
    "require_cloud_skills": 0.15,
    "require_knowledge": 0.10,
    "require_domain_knowledge": 0.05,
}

# Sector words that don't tell companies apart, longest phrases first.
SECTOR_WORDS = [
    "ĐẦU TƯ THƯƠNG MẠI PHÁT TRIỂN CÔNG NGHỆ",
    "ĐẦU TƯ THƯƠNG MẠI PHÁT TRIỂN",
    "ĐẦU TƯ PHÁT TRIỂN CHUYỂN GIAO CÔNG NGHỆ",
    "ĐẦU TƯ PHÁT TRIỂN CÔNG NGHỆ",
    "ĐẦU TƯ PHÁT TRIỂN DỊCH VỤ",
    "ĐẦU TƯ PHÁT TRIỂN",
    "ĐẦU TƯ THƯƠNG MẠI",
    "ĐẦU TƯ CÔNG NGHỆ",
    "ĐẦU TƯ GIÁO DỤC",
    "ĐẦU TƯ KỸ THUẬT",
    "THƯƠNG MẠI DỊCH VỤ XUẤT NHẬP KHẨU",
    "THƯƠNG MẠI VÀ DỊCH VỤ",
    "THƯƠNG MẠI DỊCH VỤ",
    "DỊCH VỤ THƯƠNG MẠI",
    "XUẤT NHẬP KHẨU THƯƠNG MẠI",
    "XÂY DỰNG XUẤT NHẬP KHẨU",
    "XUẤT NHẬP KHẨU",
    "TÀI CHÍNH NGÂN HÀNG",
    "DỊCH VỤ CÔNG NGHỆ",
    "GIẢI PHÁP CÔNG NGHỆ BẤT ĐỘNG SẢN",
    "GIẢI PHÁP CÔNG NGHỆ",
    "CÔNG NGHỆ GIẢI PHÁP",
    "CÔNG NGHỆ THÔNG TIN",
    "CÔNG NGHỆ GIÁO DỤC",
    "CÔNG NGHỆ QUỐC TẾ",
    "CÔNG NGHỆ TRUYỀN THÔNG",
    "CÔNG NGHỆ DỮ LIỆU",
    "CÔNG NGHIỆP VIỄN THÔNG",
    "KHOA HỌC CÔNG NGHỆ",
    "PHÁT TRIỂN CÔNG NGHỆ",
    "GIẢI PHÁP PHẦN MỀM",
    "TƯ VẤN GIÁO DỤC",
    "TƯ VẤN QUẢN LÝ",
    "TƯ VẤN CÔNG NGHỆ",
    "TƯ VẤN DỊCH VỤ",
    "TƯ VẤN PHÂN TÍCH",
    "SẢN XUẤT KINH DOANH",
    "SẢN XUẤT THƯƠNG MẠI",
    "KỸ THUẬT THƯƠNG MẠI",
    "THƯƠNG MẠI VẬN TẢI",
    "BÁN LẺ KỸ THUẬT",
    "THIẾT BỊ CÔNG NGHIỆP",
    "VẬT LIỆU XÂY DỰNG",
    "TRUNG TÂM THỂ DỤC THỂ HÌNH",
    "DỊCH VỤ DU LỊCH TRẢI NGHIỆM",
    "DỊCH VỤ DU LỊCH",
    "DỊCH VỤ ĐỊA ỐC",
    "DỊCH VỤ BẤT ĐỘNG SẢN",
    "DỊCH VỤ DI ĐỘNG TRỰC TUYẾN",
    "DỊCH VỤ DI ĐỘNG",
    "CHUYỂN PHÁT NHANH",
    "CHUYỂN ĐỔI DOANH NGHIỆP",
    "PHÂN TÍCH XỬ LÝ DỮ LIỆU",
    "GIÁO DỤC ĐÀO TẠO",
    "GIÁO DỤC QUỐC TẾ",
    "TRƯỜNG ĐẠI HỌC CÔNG NGHỆ",
    "TRƯỜNG ĐẠI HỌC",
    "BỆNH VIỆN ĐA KHOA QUỐC TẾ",
    "BỆNH VIỆN ĐA KHOA",
    "BỆNH VIỆN",
    "HỆ THỐNG Y TẾ",
    "BẤT ĐỘNG SẢN",
    "TRUYỀN THÔNG",
    "HỆ THỐNG",
    "GIÁO DỤC",
    "TÀI CHÍNH",
    "VIỄN THÔNG",
    "BẢO HIỂM",
    "AN NINH MẠNG",
    "PHẦN MỀM",
    "VẬN TẢI",
    "XÂY DỰNG",
    "DU LỊCH",
    "THỜI TRANG",
    "THỰC PHẨM",
    "DƯỢC PHẨM",
    "VÀNG BẠC ĐÁ QUÝ",
    "NHÀ HÀNG",
    "KHÁCH SẠN",
    "ĐẦU TƯ",
    "PHÁT TRIỂN",
    "THƯƠNG MẠI",
    "DỊCH VỤ",
    "VIỆT NAM",
    "CÔNG NGHỆ",
    "QUỐC TẾ",
    "GIẢI PHÁP",
    "SẢN XUẤT",
    "KỸ THUẬT",
    "TƯ VẤN",
    "TRỰC TUYẾN",
    "DI ĐỘNG",
    "Y TẾ",
    "NGÂN HÀNG",
    "LOGISTICS",
    "CHỨNG KHOÁN",
    "KIỂM TOÁN",
    "KINH DOANH",
    "BÁN LẺ",
    "THIẾT BỊ",
    "MÁY CÔNG TRÌNH",
    "TM DV",
    "TM",
    "DV",
    "SX",
    "XNK",
    "BĐS",
    "CN",
]
