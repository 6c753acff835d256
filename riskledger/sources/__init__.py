from riskledger.sources.csv_payments import read_payments_csv, scan_payments_csv
from riskledger.sources.events import payments_from_events

__all__ = ["payments_from_events", "read_payments_csv", "scan_payments_csv"]
