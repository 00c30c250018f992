"""Build the warehouse from a folder of extracts and print the verdict.

    spark-submit -m ledgerflow.run --extracts DIR --root DIR
"""

from __future__ import annotations

import argparse

from ledgerflow.plans import controls, warehouse
from ledgerflow.session import build_session
from ledgerflow.sources import layers
from ledgerflow.sources.delivery import read_delivery
from ledgerflow.sources.text_files import read_extracts


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--extracts", required=True, help="folder holding the seven CSV extracts")
    parser.add_argument("--root", required=True, help="folder of the published layers")
    parser.add_argument("--keep-rejects", action="store_true", help="load a delivery without its broken records, which are published apart")
    parser.add_argument("--multi-line", action="store_true", help="cells may hold line breaks")
    args = parser.parse_args(argv)
    spark = build_session("warehouse")
    if args.keep_rejects:
        delivery = read_delivery(spark, args.extracts, multi_line=args.multi_line)
        rejects = warehouse.publish_rejects(spark, delivery.rejects, args.root)
        layers.volume_report(rejects).show()
        tables = delivery.tables
    else:
        tables = read_extracts(spark, args.extracts, multi_line=args.multi_line)
    built = warehouse.build(spark, tables, args.root)
    results = controls.controls(built.staging, built.mart)
    results.where("statut <> 'OK'").orderBy("controle_id").show(61, truncate=False)
    print(controls.verdict(results, built.mart).first()["conclusion_finale"])


if __name__ == "__main__":
    main()
