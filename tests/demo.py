"""The three published landing files and the results recorded for them."""

CRM = """cust_id,full_name,email_addr,phone,addr_line,city,state,country,dob,updated_at
C001,Rahul Sharma,rahul.sharma@gmail.com,+91-98765-43210,12 MG Rd,Gurgaon,Haryana,India,1990-04-12,2026-06-01
C002,Priya Nair,priya.nair@yahoo.com,+91-98123-45678,4 Palm St,Bangalore,Karnataka,India,1988-11-02,2026-06-01
C003,Amit Kumar Verma,amit.verma@outlook.com,+91-99001-12233,88 Sec 21,Noida,Uttar Pradesh,India,1985-06-30,2026-06-01
C004,Sneha Iyer,sneha.iyer[at]gmail.com,+91-97654-32109,7 Lake Rd,Bombay,Maharashtra,India,1992-01-25,2026-06-01
C005,Vikram Singh,vikram.s@gmail.com,+91-96543-21098,3 Park Ave,Delhi,Delhi,India,1979-09-15,2026-06-01
C006,Ananya Das,ananya.das@gmail.com,+91-95432-10987,21 Hill Rd,Calcutta,West Bengal,India,2031-03-08,2026-06-01
C007,Karan Mehta,karan.mehta@gmail.com,+91-94321-09876,55 Ring Rd,Gurgaon,Haryana,India,1991-12-19,2026-06-01
C008,Divya Reddy,divya.reddy@gmail.com,+91-93210-98765,9 Rose Apt,Hyderabad,Telangana,India,1993-07-04,2026-06-01
C009,Rohit Sharma,rohit.sharma88@gmail.com,+91-98887-77666,5 MG Rd,Gurgaon,Haryana,India,1988-05-10,2026-06-01
C007,Karan Mehta,karan.mehta@gmail.com,+91-94321-09876,55 Ring Rd,Gurgaon,Haryana,India,1991-12-19,2026-06-15
"""

WEB_FIELDS = ["user_id", "name", "contact_email", "mobile", "street", "city_name", "region", "country_code",
              "birth_date", "modified_ts"]
WEB = [
    ("U0001", " rahul sharma  ", "RAHUL.SHARMA@GMAIL.COM", "9876543210", "121 Golf Course Road", "Gurgaon", "Haryana", "IN", "12/04/1990", "2026-07-10"),
    ("U0002", " priya nair  ", "PRIYA.NAIR@YAHOO.COM", "9812345678", "4 Palm St", "Bangalore", "Karnataka", "IN", "02/11/1988", "2026-07-10"),
    ("U0003", " amit kumar verma  ", "AMIT.VERMA@OUTLOOK.COM", "9900112233", "88 Sec 21", "Noida", "Uttar Pradesh", "IN", "30/06/1985", "2026-07-10"),
    ("U0004", " vicky singh  ", "VIKRAM.S@GMAIL.COM", "9111222333", "3 Park Ave", "Delhi", "Delhi", "IN", "15/09/1979", "2026-07-10"),
    ("U0005", " karan mehta  ", "KARAN.MEHTA@GMAIL.COM", "9432109876", "55 Ring Road", "Gurgaon", "Haryana", "IN", "19/12/1991", "2026-07-10"),
    ("U0006", " divya reddy  ", "divya.r@hotmail.com", "9000000001", "9 Rose Apt", "Hyderabad", "Telangana", "IN", "04/07/1993", "2026-07-10"),
    ("U9999", "meera joshi", "meera.j@gmail.com", "9222333444", "2 Cross St", "Pune", "Maharashtra", "IN", "14/02/1994", "2026-07-12"),
    ("U9995", "rohit sharma", "rohit.s.trader@gmail.com", "9777666555", "17 Mall Rd", "Gurgaon", "Haryana", "IN", "22/09/1996", "2026-07-11"),
    ("U9998", None, "ghost@web.com", None, None, None, None, "IN", None, "2026-07-12"),
    ("U9997", "no contact person", None, None, "1 Nowhere Ln", "Delhi", "Delhi", "IN", "01/01/1990", "2026-07-12"),
]

LEGACY = """CUST_NO|CUST_NAME|EMAIL|TEL|ADDR|CITY|ST|CTRY|BIRTH_DT|LAST_UPD
L00001|RAHUL SHARMA|rahul.sharma@gmail.com|09876543210|12 MG RD|GURGAON|HARYANA|IND|19900412|2024-01-20
L00002|AMIT KUMAR VERMA|amit.verma@outlook.com|09900112233|88 SEC 21|NOIDA|UTTAR PRADESH|IND|19850630|2024-01-20
L00003|SNEHA IYER||09765432109|7 LAKE RD|BOMBAY|MAHARASHTRA|IND|19920125|2024-01-20
L00004|ANANYA DAS|ananya.das@gmail.com|09543210987|21 HILL RD|CALCUTTA|WEST BENGAL|IND|19950308|2024-01-20
"""

QUARANTINED = {("WEB", "U9998", "DQ001"), ("WEB", "U9997", "DQ002"), ("CRM", "C006", "DQ006"), ("CRM", "C007", "DQ007")}

# Recorded MATCH pairs, by the first eight characters of either uid.
MATCHES = [("c66292ed", "edf9ca99"), ("44c6adbc", "72a37b16"), ("d5de84db", "edf9ca99"), ("5ea4fe58", "72a37b16"),
           ("c66292ed", "d5de84db"), ("44c6adbc", "5ea4fe58"), ("54c36d10", "8696df57"), ("238d3ff3", "bf3ec826"),
           ("5e647414", "f0fabc30")]
FUZZY = {("62228e42", "7b280673", 0.75, "REVIEW"), ("2f55a51e", "5c36f60e", 0.5667, "REJECTED_FP_GUARD")}

GOLDEN = {
    ("E-72a37b16da9f", "Amit Kumar Verma", "amit.verma@outlook.com", "9900112233", "Noida", "UP", "1985-06-30"),
    ("E-1c68dd92561b", "Ananya Das", "ananya.das@gmail.com", "9543210987", "Kolkata", "WB", "1995-03-08"),
    ("E-62228e429d57", "Divya Reddy", "divya.r@hotmail.com", "9000000001", "Hyderabad", "TELANGANA", "1993-07-04"),
    ("E-7b280673838d", "Divya Reddy", "divya.reddy@gmail.com", "9321098765", "Hyderabad", "TELANGANA", "1993-07-04"),
    ("E-cc08b7a44ded", "Karan Mehta", "karan.mehta@gmail.com", "9432109876", "Gurugram", "HR", "1991-12-19"),
    ("E-e92509c26881", "Meera Joshi", "meera.j@gmail.com", "9222333444", "Pune", "MH", "1994-02-14"),
    ("E-bf3ec8262da8", "Priya Nair", "priya.nair@yahoo.com", "9812345678", "Bengaluru", "KA", "1988-11-02"),
    ("E-edf9ca99e803", "Rahul Sharma", "rahul.sharma@gmail.com", "9876543210", "Gurugram", "HR", "1990-04-12"),
    ("E-2f55a51e95f1", "Rohit Sharma", "rohit.s.trader@gmail.com", "9777666555", "Gurugram", "HR", "1996-09-22"),
    ("E-5c36f60ecb75", "Rohit Sharma", "rohit.sharma88@gmail.com", "9888777666", "Gurugram", "HR", "1988-05-10"),
    ("E-8696df57410a", "Sneha Iyer", None, "9765432109", "Mumbai", "MH", "1992-01-25"),
    ("E-f0fabc3082fa", "Vikram Singh", "vikram.s@gmail.com", "9111222333", "Delhi", "DL", "1979-09-15"),
}
