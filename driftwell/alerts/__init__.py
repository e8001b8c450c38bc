"""From series of measurements to alerts, roll-ups and mail."""
