"""A small hand-made race data set as CSV files."""

CSV = {
    "circuits": "circuitId,name,lat,lng,alt\n1,Park,1.5,2.5,10\n",
    "constructorResults": "constructorResultsId,points\n1,14.5\n2,0\n",
    "constructors": "constructorId,constructorRef,name,nationality\n1,ann,Ann,Italian\n2,bob,Bob,British\n",
    "drivers": (
        "driverId,driverRef,dob,forename,surname\n1,a,1985-01-07,Al,Ace\n2,b,07/01/1985,Bo,Bee\n"
        "3,c,1990.01.01,Cy,Cee\n4,d,,Di,Dee\n5,e,2000-06-01,Ed,Eel\n"
    ),
    "lapTimes": (
        "raceId,driverId,lap,position,time,milliseconds\n"
        "1,1,1,1,1:30.0,90000\n1,1,2,1,1:30.0,90000\n1,2,1,5,1:30.0,90000\n1,2,2,4,1:30.0,90000\n"
        "1,2,3,2,1:30.0,90000\n2,1,1,3,1:30.0,90000\n2,1,2,3,1:30.0,90000\n2,2,1,2,1:30.0,90000\n"
        "3,1,1,1,1:30.0,90000\n1,3,1,6,1:30.0,90000\n"
    ),
    "pitStops": (
        "raceId,driverId,stop,lap,time,duration\n"
        "1,1,1,10,15:00:00,20.5\n1,1,2,30,15:30:00,24.9\n1,2,1,7,15:00:00,22.1\n2,1,1,7,15:00:00,30.1\n"
        "2,1,2,7,15:01:00,16:44.718\n1,3,1,5,15:00:00,21.0\n3,1,1,3,15:00:00,\\N\n"
    ),
    "races": (
        "RACEID,year,round,name,date,time,url\n1,2018,1,Spring GP,2018-03-25,06:00:00,u\n"
        "2,2018,2,Winter GP,2018-12-02,22:00:00,u\n3,2017,1,Old GP,2017-07-02,\\N,u\n"
    ),
    "results": (
        "resultId,raceId,driverId,constructorId,number,grid,position,positionText,positionOrder,points,laps,time,"
        "milliseconds,fastestLap,rank,fastestLapTime,fastestLapSpeed,statusId\n"
        "1,1,1,1,44,1,1,1,1,25,58,1:2,10,5,1,1:23.456,200.5,1\n"
        "2,1,2,2,33,2,7,7,7,6,58,+1,\\N,\\N,\\N,\\N,\\N,2\n"
        "3,2,1,1,44,1,2,2,2,18,58,+2,21,7,2,1:20.000,210.5,1\n"
        "4,2,2,2,33,3,\\N,R,11,0,30,\\N,\\N,9,9,1:25.000,190.0,3\n"
        "5,3,1,1,44,1,1,1,1,25,50,1:2,30,5,1,1:22.000,205.0,1\n"
        "6,1,3,2,12,9,8,8,8,4,58,+5,40,5,5,1:24.000,195.0,1\n"
    ),
    "status": "statusId,status\n1,Finished\n2,+1 Lap\n3,Engine\n",
}


def write(folder):
    for name, text in CSV.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)
