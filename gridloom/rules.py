"""Rule data of the document-table domain. They must equal the source domain's titles and headers."""

TARGET_TITLES = ("分部分项工程清单与计价表",)
TARGET_PATTERNS = (("分部分项工程清单与计价表", ("分部分项", "清单", "计价")),)
SKIP_TITLES = (
    "单位（专业）工程招标控制价费用表", "单位（专业）工程费用表", "专业工程费用表", "专业费用表", "主要工日一览表",
    "主要材料和工程设备一览表", "主要机械台班一览表", "主要施工机械台班一览表", "工程量确认单", "施工工艺",
    "咨询报告书目录", "工程造价审定单", "工程结算审核造价汇总表", "现场踏勘记录表", "工程现场勘察签到单",
)
SKIP_PATTERNS = (
    ("单位（专业）工程招标控制价费用表", ("招标控制价", "费用")),
    ("单位（专业）工程费用表", ("单位", "专业", "工程费用表")),
    ("施工工艺", ("施工工艺",)),
    ("专业工程费用表", ("专业工程", "费用表")),
    ("专业费用表", ("专业", "费用表")),
    ("主要工日一览表", ("主要", "工日", "一览表")),
    ("主要材料和工程设备一览表", ("主要", "材料", "工程设备", "一览表")),
    ("主要机械台班一览表", ("主要", "机械", "台班", "一览表")),
    ("工程量确认单", ("工程量", "确认单")),
)
STRUCTURES = (
    ("sub_item_project_columns", ("项目编码", "项目名称", "综合单价")),
    ("sub_item_project_columns", ("项目编码", "项目名称", "合价")),
    ("sub_item_project_long_text_columns", ("项目名称", "项目特征", "工程量")),
)
STRONG_COLUMNS = ("项目编码", "综合单价", "计算公式", "单位工程名称")

#: Column of a sub-item table: keyword sets, in the order columns are assigned.
SUB_ITEM_HEADERS = (("项目编码", "项目名称", "综合单价"), ("项目编码", "项目名称", "合价"), ("项目名称", "综合单价"), ("项目编码", "项目名称"), ("序号", "项目名称"))
SUB_ITEM_COLUMNS = (
    ("seq", ("序号",)), ("project_code", ("项目编码",)), ("project_name", ("项目名称",)), ("project_description", ("项目特征",)),
    ("unit", ("计量单位", "单位")), ("quantity", ("工程量",)), ("unit_price", ("综合单价",)), ("total_price", ("合价",)),
    ("provisional_estimate", ("暂估价", "暂估")), ("labor_cost", ("人工费",)), ("machinery_cost", ("机械费",)), ("remark", ("备注",)),
)
SUBTOTALS = ("本页小计", "合计", "小计")
SUB_ITEM_FIELDS = tuple(name for name, _ in SUB_ITEM_COLUMNS)
#: What a field may be called in model replies; a key that contains one of these stands for the field.
ALIASES = {
    "seq": ("序号",), "fee_name": ("费用名称", "名称"), "amount": ("金额", "合计"), "name_spec": ("名称规格", "名称、规格", "名称规格型号", "名称"),
    "project_name": ("项目名称", "名称"), "unit": ("计量单位", "单位"), "quantity": ("工程量", "预估工程量", "数量"), "unit_price": ("综合单价", "单价"), "total_price": ("合价",),
    "repair_content": ("维修内容", "修缮内容"), "provisional_estimate": ("暂估价", "暂估"), "labor_cost": ("人工费", "其中人工费"), "machinery_cost": ("机械费", "其中机械费"),
    "safety_civilization_fee": ("安全文明施工基本费", "安全文明施工费", "安全文明"), "regulatory_fee": ("规费",), "tax": ("税金", "税"),
}
#: The fields of each table type, and those of which only digits and dots stay.
FIELDS = {
    "unit_project_fee_table": ("seq", "fee_name", "formula", "amount", "remark"),
    "sub_item_project_table": ("seq", "project_code", "project_name", "project_description", "unit", "quantity", "unit_price", "total_price", "provisional_estimate", "labor_cost", "machinery_cost", "remark"),
    "labor_table": ("seq", "name", "unit", "quantity", "unit_price", "total_price", "remark"),
    "material_table": ("seq", "name_spec", "unit", "quantity", "unit_price", "total_price", "remark"),
    "machine_table": ("seq", "name_spec", "unit", "quantity", "unit_price", "total_price", "remark"),
    "quantity_confirm_table": ("seq", "name", "repair_content", "unit", "formula", "quantity", "remark"),
    "specialty_fee_table": ("seq", "project_name", "amount", "provisional_estimate", "safety_civilization_fee", "regulatory_fee", "tax", "remark"),
}
AMOUNTS = {
    "unit_project_fee_table": ("amount",), "quantity_confirm_table": (), "specialty_fee_table": ("amount", "provisional_estimate", "safety_civilization_fee", "regulatory_fee", "tax"),
    **{t: ("unit_price", "total_price") for t in ("sub_item_project_table", "labor_table", "material_table", "machine_table")},
}
#: Parts of sub-project and document names.
NAME_PARTS = {
    "label": "(?:单位（专业）)?工程名称[：:]",
    "title": "单位（专业）工程招标控制价费用表|单位工程费用表|分部分项工程清单与计价表|工程量确认单|专业工程费用表|专业费用表",
    "next_column": "标段[:：]?|第?\\d+页|序号|费用名称|计算公式|金额|项目编码|项目名称|项目特征|计量单位|工程量|综合单价|合价|人工费|机械费|暂估价|备注",
    "page_noise": "标段[:：]?|第?\\d+页共\\d+页|页共\\d+页|第?\\d+页|共\\d+页",
    "coordinates": "(?i)(?:[-—–_]X?\\d+){5,}$",
    "edge": "[-—–_:：]+$",
    "building": "(\\d+(?:[、,，]\\d+)*(?:[—\\-–]\\d+)*)\\s*(幢|幛|栋|号楼?|厘)",
    "room_at_end": "(?:[—\\-–]|^)(\\d{3,4}(?:[、,，—\\-–]\\d{3,4})*)(?:室|户)?$",
    "room_with_unit": "(\\d{3,4}(?:[、,，—\\-–]\\d{3,4})*)(?:室|户)$",
    "report": "(?:结算|审核|咨询)?报告书$",
    "day": "^\\d{2,4}[.．-]\\d{1,2}[.．-]\\d{1,2}",
}
#: Titles that end or rule out a construction-process section, and beginnings of lines that end it.
OTHER_TITLES = (
    "咨询报告书目录", "工程造价审定单", "专业工程费用表", "专业费用表", "工程结算审核造价汇总表", "现场踏勘记录表", "工程现场勘察签到单", "施工方案",
    "单位（专业）工程招标控制价费用表", "分部分项工程清单与计价表", "主要工日一览表", "主要材料和工程设备一览表", "主要机械台班一览表", "工程量确认单",
)
SECTION_ENDS = ("建设单位", "施工单位", "经办人", "电话", "日期", "项目主审", "复核人员", "抄送", "共印")
#: Header words that a merged table repeats, and header rows that a table type has at most.
HEADER_CELLS = {"project_name": ("项目名称", "项目编码"), "project_code": ("项目编码", "编码")}
HEADER_ROWS = {"unit_project_fee_table": 4, "sub_item_project_table": 4, "quantity_confirm_table": 3}
LONG_CELLS = ("sub_item_project_table", "quantity_confirm_table")
EXPORT_COLUMNS = ("file_name", "consultation_project_name", "consultation_time", "location", "renovation_content", "sub_item_project_rows", "sub_item_project_warnings")
#: Keys of recognition results that hold text.
CONTENT_KEYS = ("block_content", "markdown_texts", "text")
ISSUES = {
    "json_error": "JSON读取失败", "no_sub_item_rows": "没有分部分项清单行", "no_effective_sub_item_rows": "没有有效明细行",
    "has_empty_rows": "存在空行", "has_rows_without_seq": "存在缺少序号的行", "missing_report_root": "缺少reports目录，无法判断是否走Qwen",
    "missing_report": "缺少提取报告", "report_error": "提取报告读取失败", "no_qwen_pages_in_report": "报告中没有Qwen提取页",
    "qwen_rows_0_in_report": "报告中Qwen提取行数为0",
}
MODEL_ROWS = "rules_pipeline_qwen_fields"
