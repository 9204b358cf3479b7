"""rsvpark: registration and survey analytics as Spark DataFrame jobs.

Every operator takes a DataFrame of registrations (one row per attendee,
many events) and returns a DataFrame keyed by ``event_id``; nothing is
collected to the driver.
"""

__version__ = "0.1.0"
