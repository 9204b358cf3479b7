"""The 8-row trap export (FIXTURES.md section 2) and helpers to write CSVs."""

import os

TRAP_HEADER = ("Order #,Order Date,Attendee Status,Ticket Type,Total Paid,Which role best describes you?,"
               "How would you describe your AI experience?,What would you most like to get from this session?,"
               "What would you like to ask the guest speaker?,Which future topic interests you?")

TRAP_ROWS = [
    '1,2025-09-01 09:00:00,Attending,General Admission,0.00,Tech / IT | Product,'
    'Regular user — I use AI for work or study,"Networking （结识同行） | Practical skills, tips",'
    'How do agents work?,Agents | RAG',
    '2,2025-09-01 10:30:00,Attending,General Admission,0.00,Business / Entrepreneurship,Beginner - just curious,'
    'Networking （结识同行） | Networking,no,Agents',
    '3,2025-09-02 08:00:00,Attending ,Student,0.00,Tech / IT,Intermediate,Networking,n/a,RAG | Agents',
    '4,2025-09-02 23:59:59,Not Attending,General Admission,0.00,"Data, Tech / IT",Advanced, Networking （结识同行） ,'
    '  ,Agents',
    '5,2025-09-04 12:00:00,Attending,VIP,0.00,"Product,",advanced practitioner with many years of daily use,'
    '"Practical skills, tips"," What about cost,\nand risk?",',
    '6,2025-09-04 12:00:01,attending,VIP,0.00,Tech / IT | Tech / IT,,,　无　,Evals',
    '7,,Attending,,0.00,,Never used it,| ,None,  ',
    '8,2025-09-05 07:00:00,Attending,General Admission,0.00,（学生）,Intermediate,（其他）,"How ""safe"" is it?",'
    'Evals | RAG',
]


def write_csv(folder, name, header, rows):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n" + "\n".join(rows) + ("\n" if rows else ""))
    return path
