"""Names and spellings the receiving catalogue expects, and lookup tables.

These must be exactly as stated for results to load; nothing here is derived.
"""

ROOT_LOWER = "$resource"
ROOT_UPPER = "$RESOURCE"

# Associations of the core model.
RESOURCE_PARENT_CHILD = "core.ResourceParentChild"
DATASOURCE_PARENT_CHILD = "core.DataSourceParentChild"
DATASET_ELEMENT = "core.DataSetToDataElementParentship"
DATASET_FLOW = "core.DataSetDataFlow"
COLUMN_FLOW = "core.DirectionalDataFlow"

# Classes of the core model.
RESOURCE = "core.Resource"
DATA_SOURCE = "core.DataSource"
DATA_SET = "core.DataSet"
DATA_ELEMENT = "core.DataElement"

# Job hierarchy classes and associations.
JOB_PACKAGE = "com.infa.odin.models.relational"
JOB_DATABASE = f"{JOB_PACKAGE}.Database"
JOB_SCHEMA = f"{JOB_PACKAGE}.Schema"
JOB_TASK = f"{JOB_PACKAGE}.Task"
JOB_STATEMENT = f"{JOB_PACKAGE}.Statement"
JOB_CALCULATION = f"{JOB_PACKAGE}.Calculation"
DATABASE_TO_SCHEMA = f"{JOB_PACKAGE}.DatabaseToSchema"
SCHEMA_TO_TASK = f"{JOB_PACKAGE}.SchemaToTask"
TASK_TO_STATEMENT = f"{JOB_PACKAGE}.TaskToStatement"
STATEMENT_TO_CALCULATION = f"{JOB_PACKAGE}.StatementToCalculation"
STATEMENT_TEXT = f"{JOB_PACKAGE}.sourceStatementText"

# SQL script classes and associations.
SCRIPT_PACKAGE = "custom.sqlparser"
SQL_PARSER = f"{SCRIPT_PACKAGE}.SQLParser"
SQL_SCRIPT = f"{SCRIPT_PACKAGE}.SQLScript"
SQL_SCRIPT_COLUMN = f"{SCRIPT_PACKAGE}.SQLScriptColumn"
PARSER_TO_SCRIPT = f"{SCRIPT_PACKAGE}.SQLParserToSQLScript"
SCRIPT_TO_COLUMN = f"{SCRIPT_PACKAGE}.SQLScriptToSQLScriptColumn"
SCRIPT_TEXT = f"{SCRIPT_PACKAGE}.sourceStatement"

# Calculation-view classes and associations, flow model.
VIEW_PACKAGE = "custom.sap.hana.calscript.v7"
CALC_VIEW = f"{VIEW_PACKAGE}.HanaCalcView"
CALC_VIEW_FIELD = f"{VIEW_PACKAGE}.HanaCalcViewField"
SCRIPT_BLOCK = f"{VIEW_PACKAGE}.HanaScriptBlock"
VIEW_TO_FIELD = f"{VIEW_PACKAGE}.HanaCalcViewToHanaCalcViewField"
VIEW_TO_BLOCK = f"{VIEW_PACKAGE}.HanaCalcViewToHanaScriptBlock"
VIEW_CONTAINER_ID = "hana_calcviews_container"
VIEW_CONTAINER_NAME = "HANA Calculation Views"

# Calculation-view classes and associations, package-grouped model.
PACKAGE_MODEL = "custom.sap.hana.calcscript.v3"
PACKAGE = f"{PACKAGE_MODEL}.HanaPackage"
PACKAGE_TABLE = f"{PACKAGE_MODEL}.HanaTable"
PACKAGE_VIEW = f"{PACKAGE_MODEL}.HanaCalcView"
PACKAGE_FIELD = f"{PACKAGE_MODEL}.HanaCalcViewField"
PACKAGE_BLOCK = f"{PACKAGE_MODEL}.HanaScriptBlock"
PACKAGE_TO_VIEW = f"{PACKAGE_MODEL}.HanaPackageToHanaCalcView"
PACKAGE_TO_TABLE = f"{PACKAGE_MODEL}.HanaPackageToHanaTable"
PACKAGE_TABLE_TO_BLOCK = f"{PACKAGE_MODEL}.HanaTableToHanaScriptBlock"
PACKAGE_VIEW_TO_FIELD = f"{PACKAGE_MODEL}.HanaCalcViewToHanaCalcViewField"
PACKAGE_VIEW_TO_BLOCK = f"{PACKAGE_MODEL}.HanaCalcViewToHanaScriptBlock"
PACKAGE_BLOCK_TO_VIEW = f"{PACKAGE_MODEL}.HanaScriptBlockToHanaCalcView"

# Report classes and associations.
REPORT_PACKAGE = "custom.PowerBI.v3"
REPORT = f"{REPORT_PACKAGE}.Report"
SECTION = f"{REPORT_PACKAGE}.Section"
VISUAL = f"{REPORT_PACKAGE}.Visual"
REPORT_DATASET = f"{REPORT_PACKAGE}.Dataset"
REPORT_FIELD = f"{REPORT_PACKAGE}.Field"
REPORT_TO_SECTION = f"{REPORT_PACKAGE}.ReportToSection"
SECTION_TO_VISUAL = f"{REPORT_PACKAGE}.SectionToVisual"
VISUAL_TO_FIELD = f"{REPORT_PACKAGE}.VisualToField"
REPORT_TO_DATASET = f"{REPORT_PACKAGE}.ReportToDataset"
DATASET_TO_FIELD = f"{REPORT_PACKAGE}.DatasetToField"

# Lookup tables.
NODE_TYPES = {
    "JoinView": "JOIN",
    "ProjectionView": "PROJECTION",
    "AggregationView": "AGGREGATION",
    "UnionView": "UNION",
    "RankView": "RANK",
}
SCRIPT_NODE = "SCRIPT_BASED"
JOIN_TYPES = {
    "inner": "INNER",
    "leftOuter": "LEFT_OUTER",
    "rightOuter": "RIGHT_OUTER",
    "fullOuter": "FULL_OUTER",
    "cross": "CROSS",
    "text": "TEXT",
    "referential": "REFERENTIAL",
}
FIELD_TYPES = {
    "Column": "Source Column",
    "Measure": "Measure",
    "Aggregation": "Measure",
    "CountRows": "Measure",
}
OTHER_FIELD_TYPE = "Calculated Column"

# Defaults for run events that lack the part.
DEFAULT_APP = "default_app"
DEFAULT_JOB_NAMESPACE = "default_namespace"
DEFAULT_JOB = "default_job"
DEFAULT_STATEMENT = "Default_SPARK_JOB"
DEFAULT_RESOURCE = "dft_src"

# Readiness rules of the event diagnostics and what each means.
NO_INPUTS = "No inputs - Cannot generate DataSetDataFlow"
NO_OUTPUTS = "No outputs - Cannot generate DataSetDataFlow"
NO_JOB = "No job information - Cannot generate Task"
NO_SCHEMA = "No schema facet - Cannot generate column-level DataElement"
NO_COLUMN_LINEAGE = "No column lineage facet - Cannot generate DirectionalDataFlow"
INVALID_JSON = "Invalid JSON"
REASON_TEXT = {
    NO_INPUTS: "Dataset input is missing. Lineage flow cannot be established.",
    NO_OUTPUTS: "Dataset output is missing. Lineage flow cannot be established.",
    NO_JOB: "Job name/namespace missing. Task metadata cannot be created.",
    NO_SCHEMA: "Schema information missing. Cannot map columns (data elements) in the lineage.",
    NO_COLUMN_LINEAGE: "Column-level lineage not available. Cannot create directional flow between columns.",
}

# Words that are never an alias or a column in a SQL body.
SQL_KEYWORDS = [
    "SELECT", "FROM", "WHERE", "JOIN", "ON", "AND", "OR", "NOT", "IN", "IS", "NULL", "CASE", "WHEN", "THEN",
    "ELSE", "END", "AS", "BY", "GROUP", "ORDER", "HAVING", "LEFT", "RIGHT", "INNER", "OUTER", "FULL", "CROSS",
    "DISTINCT", "WITH", "INSERT", "UPDATE", "DELETE", "INTO", "VALUES", "SET", "LIKE", "BETWEEN", "EXISTS",
    "UNION", "ALL", "LIMIT", "OFFSET", "TOP",
]

# Export headers, in column order.
REFERENCE_HEADER = ["core.externalId", "core.Reference", "core.assignable", "core.name"]
STATEMENT_HEADER = ["core.externalId", "core.reference", "core.assignable", "core.name", STATEMENT_TEXT]
RESOURCE_HEADER = ["core.externalId", "core.name", "core.reference", "core.assignable"]
SQL_PARSER_HEADER = [
    "core.externalId", "core.name", "core.description", "core.assignable",
    "core.businessDescription", "core.businessName", "core.reference",
]
SQL_SCRIPT_HEADER = [
    "core.externalId", "core.name", "core.description", "core.businessDescription",
    "core.businessName", "core.reference", SCRIPT_TEXT,
]
SQL_SCRIPT_COLUMN_HEADER = [
    "core.externalId", "core.name", "core.description", "core.businessDescription", "core.businessName",
    "com.infa.ccgf.models.cdam.protectionConfig", "com.infa.ccgf.models.cdam.protectionIsReidentifiable",
    "com.infa.ccgf.models.cdam.protectionTechniqueLabel", "com.infa.ccgf.models.cdam.protectionValueIsModified",
    "core.reference", SCRIPT_TEXT,
]
CALC_VIEW_HEADER = [
    "core.externalId", "core.name", "core.description", "core.assignable",
    f"{VIEW_PACKAGE}.packagePath", f"{VIEW_PACKAGE}.calcViewType", f"{VIEW_PACKAGE}.defaultClient",
]
CALC_VIEW_FIELD_HEADER = [
    "core.externalId", "core.name", "core.description", "core.assignable",
    f"{VIEW_PACKAGE}.keyAttribute", f"{VIEW_PACKAGE}.columnExpression", f"{VIEW_PACKAGE}.columnDataType",
]
SCRIPT_BLOCK_HEADER = [
    "core.externalId", "core.name", "core.parent", "core.assignable",
    f"{VIEW_PACKAGE}.scriptType", f"{VIEW_PACKAGE}.transformationLogic",
]
PACKAGE_HEADER = ["core.externalId", "core.name", "core.description", "core.reference", "core.assignable"]
PACKAGE_TABLE_HEADER = PACKAGE_HEADER + [f"{PACKAGE_MODEL}.tableSchema"]
PACKAGE_VIEW_HEADER = PACKAGE_HEADER + [
    f"{PACKAGE_MODEL}.packagePath", f"{PACKAGE_MODEL}.sourceSchema",
    f"{PACKAGE_MODEL}.calcViewType", f"{PACKAGE_MODEL}.defaultClient",
]
PACKAGE_FIELD_HEADER = PACKAGE_HEADER[:4] + [
    f"{PACKAGE_MODEL}.keyAttribute", f"{PACKAGE_MODEL}.columnExpression", f"{PACKAGE_MODEL}.columnDataType",
]
PACKAGE_BLOCK_HEADER = PACKAGE_HEADER + [
    f"{PACKAGE_MODEL}.scriptType", f"{PACKAGE_MODEL}.transformationLogic", f"{PACKAGE_MODEL}.joinType",
    f"{PACKAGE_MODEL}.filterCondition", f"{PACKAGE_MODEL}.complexityScore",
    f"{PACKAGE_MODEL}.sourceTableCount", f"{PACKAGE_MODEL}.sourceSchema",
]
REPORT_HEADER = [
    "core.externalId", "core.name", "core.description", "core.businessDescription",
    "core.businessName", "core.reference",
]
VISUAL_HEADER = REPORT_HEADER + [f"{REPORT_PACKAGE}.VisualQuery", f"{REPORT_PACKAGE}.VisualType"]
REPORT_FIELD_HEADER = REPORT_HEADER + [f"{REPORT_PACKAGE}.FieldType"]
REPORT_CORE_HEADER = ["core.externalId", "core.reference", "core.assignable", "core.name"]
LINK_HEADER = ["Source", "Target", "Association"]
