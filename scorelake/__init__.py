"""Tables in, score-model validation out: a PySpark toolkit for data scientists."""

from .functions.crypto import decrypt_columns, encrypt_columns
from .functions.expr import (
    binarize,
    clean_number,
    extract_id,
    guarded_log,
    human_size,
    predict,
    psi,
    round_even,
    safe_div,
)
from .functions.text import clean_columns, clean_text
from .functions.types import cast_schema, normalize_decimals, parse_type, shrink_types
from .operators.binning import assign_bin, cut_bin, quantile_edges
from .operators.binstat import bin_stat
from .operators.classify import classification_stats, target_type, target_types
from .operators.columns import (
    drop_columns,
    first_per_key,
    join_on,
    rename_columns,
    require_columns,
    select_columns,
    select_regex,
    stack,
    stitch_columns,
    strip_qualifiers,
    usage_report,
)
from .operators.dates import DateRange, date_ranges, filter_dates, range_number, with_date_range
from .operators.documents import assemble_documents, split_documents
from .operators.performance import performance_by_date, performance_table
from .operators.prefix import PageIndex, chunk_ids, prefix_sums, row_numbers
from .operators.profile import column_profile, column_sizes, nunique, result_size
from .operators.roc import auc, ks, roc_curve, roc_summary
from .plans.reports import binary_report, binary_report_by_date, model_report, pivot_by_date
from .sources.catalog import (
    describe_table,
    list_columns,
    list_schemas,
    list_tables,
    list_views,
    show_create,
    table_detail,
    table_exists,
)
from .sources.jdbc import doris_url, oracle_url, read_jdbc, write_jdbc
from .sources.exports import changed_chunks, export_ordered, manifest, read_ordered
from .sources.sinks import (
    append_csv,
    create_like,
    drop_table,
    export_chunked,
    insert_rows,
    read_chunks,
    rename_table,
    save_table,
    split_table,
    write_csv,
)
from .sources.statements import (
    run_sql,
    run_sql_file,
    run_sql_script,
    run_sqls,
    session_with,
    split_statements,
    with_conf,
)
from .sources.tables import (
    iter_batches,
    load,
    load_file,
    read_table,
    read_tables,
    read_text_blocks,
    table_sizes,
)

__all__ = [name for name in dir() if not name.startswith("_")]
