"""Schemas of the configuration tables, the run log and the result tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(text: str, required: str = "") -> T.StructType:
    """Columns as "name type(length)"; the ones named in ``required`` may not be null."""
    out = []
    for name, kind in (x.split() for x in text.split(",")):
        kind, _, length = kind.partition("(")
        made = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampNTZType()}[kind]
        out.append(T.StructField(name, made, name not in required.split(), {"length": int(length[:-1])} if length else {}))
    return T.StructType(out)


# The table and column names, types and lengths that users' configurations refer to.
API_MST = _table(
    "api_id string(150), api_name string(100), api_group string(100), request_type string(20), api_url string(500), header_json string, payload_type string(20), payload_json string, "
    "payload_xml string, response_type string(20), response_parse_json string, persist_env_json string, output_tables_json string, merge_fields_json string, key_params_list string, "
    "description string(100), updated_at timestamp",
    "api_id api_name api_group request_type api_url header_json",
)
API_JOB_BUILDER = _table(
    "build_id string(50), api_id string(150), macro_params_json string, is_active boolean, save_mode string(20), execution_cycle string(20), description string(100), updated_at timestamp",
    "build_id api_id macro_params_json is_active",
)
API_JOB = _table(
    "job_id string(150), build_id string(50), api_id string(150), params_json string, is_active boolean, save_mode string(20), execution_cycle string(20), description string(100), updated_at timestamp",
    "job_id api_id params_json is_active",
)
API_JOB_LOG = _table("id long, job_id string(150), status string(20), error_message string(4000), executed_at timestamp", "id job_id status")
API_RST = _table("id long, api_id string(150), job_id string(150), key_params_json string, result_json string, updated_at timestamp", "api_id job_id result_json")
_OHLC = "futs_prpr double, futs_oprc double, futs_hgpr double, futs_lwpr double"
_PRICE = _table(
    f"id long, api_id string(150), job_id string(150), short_code string(20), trade_at string(14), {_OHLC}, futs_mxpr double, futs_llam double, futs_sdpr double, futs_prdy_clpr double, "
    "futs_prdy_vrss double, futs_prdy_ctrt double, hts_thpr double, hts_ints_vltl double, hist_vltl double, delta_val double, gama double, theta double, vega double, rho double, acpr double, "
    "dprt double, futs_lstn_medm_hgpr double, futs_lstn_medm_lwpr double, kospi200_idx double, acml_vol long, acml_tr_pbmn long, hts_otst_stpl_qty long, otst_stpl_qty_icdc long, "
    "hts_rmnn_dynu long, prdy_vrss_sign string(4), futs_last_tr_date string(8), hts_kor_isnm string(100), updated_at timestamp",
    "api_id job_id",
)
_CODES = _table(
    "id long, api_id string(150), job_id string(150), info_type string(2), short_code string(20), std_code string(20), kor_name string(100), atm_cls_code string(2), acpr double, "
    "mmsc_cls_code string(2), unas_short_code string(20), unas_kor_name string(100), updated_at timestamp",
    "api_id job_id",
)
_CHART = _table(
    f"id long, api_id string(150), job_id string(150), short_code string(20), trade_date string(8), hhmm string(6), stck_bsop_date string(8), stck_cntg_hour string(6), {_OHLC}, "
    "cntg_vol long, acml_tr_pbmn long, updated_at timestamp",
    "api_id job_id stck_bsop_date stck_cntg_hour",
)

CONFIG = {"api_mst": API_MST, "api_job_builder": API_JOB_BUILDER, "api_job": API_JOB, "api_job_log": API_JOB_LOG}
KEYS = {"api_mst": "api_id", "api_job_builder": "build_id", "api_job": "job_id"}
#: The result tables that there are from the start; a ``Tables`` may have more.
RESULTS: dict[str, T.StructType] = {"api_rst": API_RST, "kis_futopt_price": _PRICE, "fo_idx_code_mst": _CODES, "kis_futopt_chart": _CHART}


def is_generic(schema: T.StructType) -> bool:
    """Whether a result table keeps whole records as JSON."""
    return "result_json" in schema.names
