from tierline.sources.files import in_scan_order, read_csv_bronze, read_json_items, read_xml_bronze
from tierline.sources.incremental import high_watermark, read_incremental, read_jdbc
from tierline.sources.lineage import all_strings, with_lineage
from tierline.sources.split_csv import read_csv_split

__all__ = [
    "all_strings",
    "high_watermark",
    "in_scan_order",
    "read_csv_bronze",
    "read_csv_split",
    "read_incremental",
    "read_jdbc",
    "read_json_items",
    "read_xml_bronze",
    "with_lineage",
]
