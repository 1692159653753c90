"""Word lists, cues, patterns, label maps and thresholds of the clinical vocabulary."""

# Output labels by internal type.
TYPE_LABELS = {
    "symptom": "TRIỆU_CHỨNG",
    "lab_test": "TÊN_XÉT_NGHIỆM",
    "lab_result": "KẾT_QUẢ_XÉT_NGHIỆM",
    "diagnosis": "CHẨN_ĐOÁN",
    "drug": "THUỐC",
}
OUTPUT_ASSERTIONS = ["isNegated", "isFamily", "isHistorical"]

# Section headings, in order of precedence.
SECTIONS = {
    "admission_reason": ["lý do nhập viện", "lí do nhập viện"],
    "current_illness": ["bệnh sử hiện tại", "triệu chứng hiện tại", "diễn tiến bệnh", "diễn biến", "thời điểm khởi phát triệu chứng", "các triệu chứng hiện tại"],
    "past_history": ["tiền sử", "tiền căn", "tiền sử bệnh", "tiền sử bệnh nội khoa"],
    "medication_history": ["tiền sử dùng thuốc", "thuốc đang dùng", "thuốc trước khi nhập viện", "toa thuốc", "medication", "medications"],
    "diagnosis": ["chẩn đoán", "đánh giá", "assessment", "diagnosis"],
    "treatment": ["điều trị", "kế hoạch", "plan"],
    "family_history": ["tiền sử gia đình", "gia đình"],
}

SYMPTOMS = [
    "sốt", "ho", "ho khan", "ho đờm", "ho đờm xanh", "khó thở", "thở khò khè", "đau ngực", "tức ngực", "đau bụng",
    "đau thượng vị", "buồn nôn", "nôn", "ói", "chóng mặt", "mệt", "mệt mỏi", "phù", "đau đầu", "tiêu chảy", "táo bón",
    "sụt cân", "chán ăn", "đau lưng", "đau họng", "khàn tiếng", "hồi hộp", "đánh trống ngực", "ngất", "ngất xỉu",
    "co giật", "yếu liệt", "tê bì", "tê tay", "tê chân", "cảm giác thắt chặt ngực", "khó chịu vùng ngực", "ợ hơi",
    "ợ chua", "chảy máu", "tiểu buốt", "tiểu rắt", "tiểu máu", "vàng da", "ngứa", "nổi ban", "phát ban",
]
DIAGNOSES = [
    "tăng huyết áp", "đái tháo đường", "tiểu đường", "suy tim", "nhồi máu cơ tim", "bệnh mạch vành", "viêm phổi",
    "hen phế quản", "copd", "bệnh phổi tắc nghẽn mạn tính", "suy thận", "bệnh thận mạn", "xơ gan", "viêm gan",
    "tai biến mạch máu não", "đột quỵ", "nhiễm trùng", "nhiễm khuẩn", "rối loạn lipid máu", "ung thư", "thiếu máu",
    "hội chứng não gan", "bệnh trào ngược dạ dày - thực quản", "trào ngược dạ dày - thực quản",
    "bệnh trào ngược dạ dày- thực quản",
]
SYMPTOM_HEADS = ["đau", "sốt", "ho", "khó thở", "mệt", "nôn", "buồn nôn", "chóng mặt", "phù", "ngất", "tê", "yếu", "tiêu chảy", "táo bón", "ợ", "tiểu", "chảy máu"]
GENERIC_ALIASES = ["bệnh", "bệnh hiện tại", "tiền sử bệnh", "triệu chứng", "triệu chứng hiện tại", "chẩn đoán", "điều trị", "theo dõi", "khác", "không xác định"]
DIAGNOSIS_CUE = r"(?:chẩn đoán|được chẩn đoán|kết luận|theo dõi|nghĩ nhiều|mắc bệnh|bị bệnh)\s*[:\-]?\s*"
HISTORY_CUE = r"(?:tiền sử|ts|bệnh sử)\s+(?:bị|mắc|có|được chẩn đoán)?\s*"
COMPLAINT_CUE = r"(?:vào viện vì|lý do vào viện|than phiền|triệu chứng)\s*[:\-]?\s*"
PHRASE_SPLIT = r"\s*(?:,|;|\bvà\b|\bkèm\b|\s+-\s+)\s*"

DRUGS = [
    "aspirin", "amlodipine", "metoprolol", "atenolol", "doxycycline", "levofloxacin", "tylenol", "paracetamol",
    "acetaminophen", "insulin", "warfarin", "heparin", "ceftriaxone", "omeprazole", "atorvastatin", "simvastatin",
    "furosemide", "losartan", "metformin", "chlorpheniramine", "capsaicin", "salbutamol", "prednisolone", "cefuroxime",
    "azithromycin", "amoxicillin", "clavulanate", "pantoprazole", "esomeprazole",
]
DRUG_UNIT = r"(?:mg|mcg|µg|g|ml|mL|l|iu|IU|units?|đv|%)(?![A-Za-zÀ-ỹĐđ])"
DRUG_STRENGTH = rf"\d+(?:[.,]\d+)?\s*{DRUG_UNIT}(?:\s*/\s*{DRUG_UNIT})?"
DRUG_ROUTE = r"(?:po|iv|im|sc|uống|tiêm|truyền|ngậm|bôi|xịt|nhỏ)"
DRUG_FREQUENCY = r"(?:qd|bid|tid|qid|qhs|prn|mỗi ngày|ngày\s*\d+\s*lần|x\s*\d+|sáng|trưa|chiều|tối)"
DRUG_WORD = r"[A-Za-z][A-Za-z0-9+/\-]*"
DRUG_CUE = r"(?:thuốc|dùng|sử dụng|điều trị|toa thuốc)\s*[:\-]?\s*"

LABS = [
    "WBC", "TWBC", "NEUT%", "LYPH%", "LYMPH%", "RBC", "HGB", "Hb", "HCT", "PLT", "MCV", "MCH", "MCHC", "ALT", "AST", "GGT",
    "ALP", "CRP", "ESR", "Creatinine", "Ure", "BUN", "Glucose", "Troponin", "BNP", "NT-proBNP", "INR", "PT", "aPTT", "Na",
    "K", "Cl", "HbA1c", "Bilirubin", "Albumin", "Protein", "LDH", "CK", "CK-MB", "D-dimer", "Ferritin", "Procalcitonin",
    "TSH", "FT3", "FT4", "T3", "T4",
]
STRICT_LABS = [
    "ag", "anion gap", "ap", "bạch cầu", "bicarbonate", "bilirubin trực tiếp", "bilirubin toàn phần", "canxi",
    "canxi ion hóa", "canxi toàn phần", "chloride", "cr", "creatinin", "egfr", "hco3", "hemoglobin", "huyết cầu tố",
    "huyết sắc tố", "kali", "lactate", "lipase", "lymphocyte", "magie", "magnesium", "natri", "neutrophil", "phosphate",
    "phosphatase kiềm", "platelets", "potassium", "sodium", "tbili", "tiểu cầu",
]
LAB_VALUE = r"[<>]?\s*\d+(?:[,.]\d+)?(?:\s*(?:mg/dL|mmol/L|µmol/L|umol/L|g/L|g/dL|U/L|IU/L|ng/L|ng/mL|pg/mL|mEq/L|mmHg|10\^9/L|10\^12/L|%))?"
BLOCK_VALUE = r"[<>]?[ \t]*\d+(?:[,.]\d+)?(?:[ \t]*(?:%|mg/dL|mmol/L|µmol/L|umol/L|g/L|g/dL|U/L|IU/L|ng/L|ng/mL|pg/mL|mEq/L|mmHg|10\^9/L|10\^12/L|K/uL|M/uL))?"
GENERIC_LAB_NAME = r"[A-Za-zÀ-ỹĐđ][A-Za-zÀ-ỹĐđ0-9%/\- ]{1,80}"
BLOCK_NAME = r"[A-Za-zÀ-ỹĐđ][^\n:;=]{1,70}?"
NOT_LABS = ["tuổi", "mạch", "nhiệt độ", "huyết áp", "địa chỉ", "số điện thoại", "ngày", "tháng", "năm", "nam", "nữ", "cân nặng", "chiều cao", "nhịp thở", "spo2"]
LAB_BLOCK_OPEN = ["ket qua xet nghiem", "xet nghiem can lam sang", "laboratory results", "laboratory"]
LAB_BLOCK_CLOSE = ["ket qua chan doan hinh anh", "chan doan hinh anh", "chan doan", "danh gia", "dieu tri", "thuoc", "thu thuat", "ke hoach", "cac phat hien chan doan", "cac phat hien khac"]
BLOCK_SUFFIX = r"[ \t]+(?:vào[ \t]+ngày|lặp[ \t]+lại|trả[ \t]+về|vẫn|dai[ \t]+dẳng|tăng[ \t]+từ|bắt[ \t]+đầu|cải[ \t]+thiện|giảm[ \t]+xuống|tăng[ \t]+lên|tăng)\b.*$"
BLOCK_BAD_CUES = ["binh thuong", "rung nhi", "dap ung that", "nhip tim", "huyet ap"]
LONG_TESTS = r"tổng phân tích tế bào máu(?:\s+bằng\s+máy\s+lazer)?(?:\s*\([^)]+\))?|công thức máu|sinh hóa máu|khí máu động mạch|phân tích nước tiểu|tổng phân tích nước tiểu|x-quang ngực|xquang ngực|điện tâm đồ|siêu âm tim|siêu âm ổ bụng|ct scanner|chụp cắt lớp|mri|monitor holter"
QUALITATIVE = ["âm tính", "dương tính", "bình thường", "tăng", "giảm"]

NEGATION = ["không", "không ghi nhận", "không có", "chưa ghi nhận", "phủ nhận", "âm tính"]
SPECULATION = ["nghi ngờ", "theo dõi", "khả năng", "có thể", "chưa loại trừ", "rule out", "r/o"]
FAMILY = ["gia đình", "bố", "ba", "cha", "mẹ", "anh", "chị", "em", "anh trai", "chị gái"]
HISTORICAL = ["tiền sử", "đã từng", "trước đây", "trước khi nhập viện", "đang dùng tại nhà"]

# Texts, prefixes and words of spans that carry nothing.
DROP_DIAGNOSIS = ["bệnh", "bệnh hiện tại", "tiền sử bệnh", "chẩn đoán", "hình ảnh", "khác", "không xác định"]
DROP_DIAGNOSIS_PREFIX = ["phẫu thuật", "thủ thuật", "xử trí", "lý do nhập viện", "hình ảnh", "thăm dò", "sau đó", "trước vào viện", "hiện "]
DROP_DIAGNOSIS_COLON_PREFIX = ["hình ảnh", "lý do nhập viện", "kết quả chẩn đoán"]
DROP_LAB = ["dấu hiệu sinh tồn là", "được con trai phát hiện tại nhà lúc khoảng 11", "khoảng 11", "lý do nhập viện", "nhịp thở", "spo2", "tần suất", "thời gian", "thời gian khởi phát", "thời điểm khởi phát triệu chứng", "truyền dịch"]
DROP_LAB_PREFIX = ["bắt đầu nhận thấy", "được con trai phát hiện", "thời điểm khởi phát"]
DROP_SYMPTOM = [
    "các biến trước khi nhập viện", "các diễn biến trước khi nhập viện", "cận lâm sàng trước khi nhập viện",
    "cần phải ho nó ra", "đã khám bác sĩ chăm sóc chính hai lần", "đến gặp bác sĩ chăm sóc chính sáng nay",
    "đi khám lại bác sĩ chăm sóc chính vào hôm qua", "điều trị",
    "ho rối loạn cảm xúc (trầm cảm) (tiền sử giai đoạn trầm cảm không đặc hiệu)", "hoặc các triệu chứng khác",
    "nhập viện tại khoa cấp cứu để điều trị thêm", "ngày càng nặng hơn", "sau đó nhaoaj viện tại khoa cấp cứu",
    "sự kiện trước khi nhập viện", "thỉnh thoảng tiêu chảy các thuốc của ông ấy", "thủ thuật điện chọn",
    "tổn thương chi dưới do tự tử không thành", "vị trí không xác định", "xảy ra vài lần mỗi ngày",
]
DROP_SYMPTOM_PREFIX = ["cơn đau thắt ngực không ổn định cần ", "đến khám để thực hiện ", "nhập viện tại", "phim chụp ct hình ảnh ", "sau đó nhaoaj viện"]
NON_SYMPTOM_PREFIX = ["khi ", "lúc ", "tại "]
NON_SYMPTOM_WORDS = ["khoa", "bệnh viện", "cấp cứu"]

# Drug sigs, forms and term types.
SIG_WORDS = ["po", "iv", "im", "sc", "daily", "bid", "tid", "qid", "qhs", "qam", "q6h", "prn", "xl", "xr", "er", "sr", "cr"]
FORMS = ["tablet", "capsule", "suspension", "solution", "cream", "ointment", "injection", "patch", "suppository", "powder", "granules", "spray"]
TTY_BONUS = {"SCD": 0.07, "SBD": 0.06, "PSN": 0.06, "SCDC": 0.03, "SBDC": 0.02, "SCDF": 0.02, "SBDF": 0.01, "SCDG": 0.01, "SBDG": 0.01, "CD": 0.065}
TTY_KEEP = ["IN", "PIN", "MIN", "BN", "SCD", "SBD", "SCDC", "SBDC", "SCDF", "SBDF", "SCDG", "SBDG", "PSN", "CD", "GPCK", "BPCK"]
SOURCE_PRIORITY = {"RxNorm": 4, "ICD10_TT06": 4, "ICD10_VI": 3, "custom": 2, "SNOMED": 1}
RXNORM_VERSION = "2026-07-06"

# alias, canonical name, concept, source, semantic type
BUILTIN_ALIASES = [
    ("tylenol", "acetaminophen", "Rx161", "RxNorm", "drug"),
    ("paracetamol", "acetaminophen", "Rx161", "RxNorm", "drug"),
    ("acetaminophen", "acetaminophen", "Rx161", "RxNorm", "drug"),
    ("aspirin", "aspirin", "", "RxNorm", "drug"),
    ("amlodipine", "amlodipine", "", "RxNorm", "drug"),
    ("metoprolol", "metoprolol", "", "RxNorm", "drug"),
    ("atenolol", "atenolol", "", "RxNorm", "drug"),
    ("doxycycline", "doxycycline", "", "RxNorm", "drug"),
    ("xơ gan", "xơ gan", "ICD10:K74", "ICD10_VI", "diagnosis"),
    ("tăng huyết áp", "tăng huyết áp", "ICD10:I10", "ICD10_VI", "diagnosis"),
    ("đái tháo đường", "đái tháo đường", "ICD10:E11", "ICD10_VI", "diagnosis"),
    ("tiểu đường", "đái tháo đường", "ICD10:E11", "ICD10_VI", "diagnosis"),
    ("viêm phổi", "viêm phổi", "ICD10:J18", "ICD10_VI", "diagnosis"),
    ("đột quỵ", "đột quỵ", "ICD10:I64", "ICD10_VI", "diagnosis"),
    ("trào ngược dạ dày - thực quản", "trào ngược dạ dày - thực quản", "ICD10:K21.9", "ICD10_VI", "diagnosis"),
]

# Token labels of NER models to internal types, tried in this order as substrings.
NER_LABELS = {
    "SYMPTOM": "symptom", "DISEASESYMTOM": "symptom", "SIGN": "symptom", "DISEASE": "diagnosis", "DIAGNOSIS": "diagnosis",
    "PROBLEM": "diagnosis", "DRUG": "drug", "DRUGCHEMICAL": "drug", "MEDICATION": "drug", "MEDICINE": "drug",
    "TEST": "lab_test", "LAB_TEST": "lab_test", "DIAGNOSTICS": "lab_test", "MEDDEVICETECHNIQUE": "lab_test",
    "RESULT": "lab_result", "LAB_RESULT": "lab_result", "UNITCALIBRATOR": "lab_result",
}

# What an audit takes for a letter of a word, and a text that breaks off.
AUDIT_WORD = r"^[A-Za-zÀ-ỹĐđ0-9]"
TRAILING_FRAGMENT = r"(?iuU)\b(?:trong|cho|và|với|của|tại|do|để|khi|ngày|lần|khả|ng|kh|v)\s*\z"

# A drug name of one word, and what says that a drug was taken before.
DRUG_TOKEN = r"^[A-Za-zÀ-ỹĐđ]{5,}\z"
HISTORICAL_CONTEXT = ["tiền sử", "trước đây", "trước khi nhập viện", "lần nhập viện trước", "thuốc đang dùng trước", "đang dùng tại nhà", "ở nhà bệnh nhân đã", "đã sử dụng", "đã điều trị"]
HISTORICAL_HEADING = ["các sự kiện trước khi nhập viện"]
