"""Fixed values that must equal the reporting system's for right results.

Kept together, as plain text, in natural order.
"""

# --- fixed values -----------------------------------------------------------
# Report time zone of the wall-clock formats (UTC+7, no daylight saving).
REPORT_TZ = "Asia/Bangkok"
STORAGE_TZ = "UTC"

# Buddhist era offset in years.
BE_YEARS = 543

# Insurance plan names that count as self-pay when the plan has no category code.
CASH_PLAN_NAMES = ("เงินสด", "เงินสด เบิกได้")

# Scheme columns of the daily scheme report and the category codes in each.
SCHEME_UCS = ("UCS",)
SCHEME_SSS = ("SSS",)
SCHEME_OFC = ("OFC", "BKK", "BMT", "LGO", "NHS")
SCHEME_CASH = ("CASH",)
CATEGORY_CASH = "CASH"
CATEGORY_OTHER = "OTHER"

# Status of a finished visit / encounter.
STATUS_COMPLETED = "completed"

# Labels.
ALL_LABEL = "ทั้งหมด"  # "all", default for an unset filter in meta
TOTAL_LABEL_TH = "รวม"  # "total" row label of the scheme report
TOTAL_LABEL = "Total"  # total row label of the clinic new/old report
TOTAL_LABEL_PRINT = "รวมทั้งหมด"  # printed label of that total row
NEW_TH = "ใหม่"  # "new" patient type in the clinic report
OLD_TH = "เก่า"  # "old" patient type in the clinic report
NEW_PATIENT_TH = "ผู้ป่วยใหม่"  # "new patient" in the plan summary content
OLD_PATIENT_TH = "ผู้ป่วยเก่า"  # "old patient" in the plan summary content
DATE_RANGE_PREFIX = "ตั้งแต่วันที่ "  # "from date "

# Report names (meta.report_name).
NAME_SCHEME = "รายงานจำนวนผู้ป่วยแยกตามสิทธิการรักษา"
NAME_APPOINTMENT = "Appointment Report"
NAME_DIAGNOSIS = "รายงานจำนวนผู้ป่วยตามรหัสโรค (ICD-10)"
NAME_CLINIC_TYPE = "รายงานผู้ป่วยใหม่/เก่า แยกตามคลินิก"
NAME_SERVICE_TIME = "รายงานระยะเวลาในการรับบริการ"
NAME_COMPLETED = "รายงานจำนวนผู้ป่วยที่มาลงทะเบียนประจำวัน"

# Presentation keys of the scheme report rows (date, gold card, social
# security, civil servant, self-pay).
SCHEME_KEYS_TH = ("วันที่", "บัตรทอง", "ประกันสังคม", "ข้าราชการ", "ชำระเงินเอง")
SCHEME_KEYS = ("visit_date", "ucs", "sss", "ofc", "cash")

# Gender spellings.
MALE_VALUES = ("male", "m", "1", "ชาย")
FEMALE_VALUES = ("female", "f", "2", "หญิง")

# Thai abbreviated month names, January to December.
THAI_MONTHS_SHORT = (
    "ม.ค.", "ก.พ.", "มี.ค.", "เม.ย.", "พ.ค.", "มิ.ย.",
    "ก.ค.", "ส.ค.", "ก.ย.", "ต.ค.", "พ.ย.", "ธ.ค.",
)

# Cashier report: patient types, visit-time codes (in hours / after hours).
CASHIER_PATIENT_TYPES = ("OPD", "IPD")
CASHIER_VISIT_TIMES = ("AT", "ET")
# --- end of fixed values ----------------------------------------------------
